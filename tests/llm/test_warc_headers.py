"""Header blocks that are long or hold the magic line, and archives whose chain breaks."""

from __future__ import annotations

import os

import pytest

from cutframe.llm import warc

URLS = ["http://h/a", "http://h/" + "u" * 70_000, "http://h/WARC/1.1", "http://h/b", "WARC/1.1", "http://h/" + "é" * 200_000 + "WARC/1.1", "http://h/WARC/1.1\r\n", None, "http://h/c"]


@pytest.mark.parametrize("block", ["1m", "64k"])
def test_every_page_comes_back(spark, block):
    pages = spark.createDataFrame([(i, u, f"<p>{i}</p>" + "WARC/1.1" * (i % 2)) for i, u in enumerate(URLS)], "page_id long, url string, html string").coalesce(1)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        got = {r.page_id: r for r in warc.archive(pages, with_payload=True).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {i: r.url for i, r in got.items()} == {i: u and u.strip() for i, u in enumerate(URLS)}
    assert all(r.intact and r.payload == (f"<p>{i}</p>" + "WARC/1.1" * (i % 2)).encode() for i, r in got.items())


def test_broken_chain_is_an_error(spark, tmp_path):
    record = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Page-ID: {}\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    os.makedirs(tmp_path / "a")
    for name, text in (("whole", record.format(1) + record.format(2)), ("no-end", (record.format(3) + record.format(4))[:-4])):
        (tmp_path / "a" / name).write_bytes(text.encode())
    assert {r.page_id for r in warc.read_warc(spark, f"file://{tmp_path}/a").collect()} == {1, 2, 3, 4}
    (tmp_path / "a" / "cut").write_bytes((record.format(5) + "WARC/1.1\r\nno header\r\n\r\n" + record.format(6)).encode())
    with pytest.raises(ValueError, match="no record at byte"):
        warc.read_warc(spark, f"file://{tmp_path}/a")
