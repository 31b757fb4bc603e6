"""License scans against plain search, notices with edits, and edge cases."""

from __future__ import annotations

import random
import re

import pytest

from cutframe.llm import licenses as li
from cutframe.llm import queries as q

A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Phrases and labels as the query's contract lists them.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(A_TO_Z))
    places = [(i, label) for phrase, label in BASE.items() for p in [phrase.split()] for i in range(len(words)) if words[i : i + len(p)] == p]
    at = [i for i, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in places}))


def told(r):
    return r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = q.op11_license_scan(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert told(r) == plain(texts[r.doc_id])
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert sorted(set(r.labels.split(","))) == r.labels.split(",") and (r.score > 0) == (r.labels != "")
    assert any(r.base_labels for r in rows)


def test_no_python_on_the_way(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plans = li.scan(docs)._jdf.queryExecution().toString() + li.hits(docs.selectExpr("struct(0 as _) kept", "binary('') key", "split(text, ' ') words"), spark, [(t, n, True) for t, n in li.PHRASES], 3)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plans) and "BroadcastHashJoin" in plans


def test_random_words(spark):
    rng = random.Random(5)
    vocabulary = ["gnu", "general", "public", "license", "apache", "CC", "by", "mit", "MIT", "License", "x", "é", "ccby", "Kcc"]
    gaps = [" ", "-", ", ", "\n", "_", "\x7f", "("]
    texts = ["".join(rng.choice(vocabulary) + rng.choice(gaps) for _ in range(rng.randrange(40))) for _ in range(400)] + ["cc by", "by cc by cc by", "(CC-BY)", "xcc by", "İcc by"]
    rows = li.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(rows) == len(texts) and all(told(r) == plain(texts[r.doc_id]) for r in rows)


NOTICE = max((t for t, label in li.NOTICES if label == "mit"), key=len).split()


@pytest.mark.parametrize(("words", "label"), [
    (NOTICE, "mit"),
    (["so", "here"] * 20 + NOTICE + ["end"], "mit"),
    (NOTICE[:20] + ["dear", "reader"] + NOTICE[20:40] + NOTICE[41:], "mit"),
    (NOTICE[: len(NOTICE) // 2], ""),
    (NOTICE[::-1], ""),
    ("gnu general public license version 3".split(), "gpl,gpl-3.0"),
    ("gnu general public license version 4".split(), "gpl"),
    ("licensed under cc by nc 4 0".split(), "cc-by,cc-by-nc"),
])
def test_notices(spark, words, label):
    (r,) = li.scan(spark.createDataFrame([(" ".join(words),)], "text string")).collect()
    assert r.labels == label and (r.score > 0.7) == bool(label) and r.n_words == len(words)
    if label == "mit":
        (span,) = r.spans
        assert span.label == "mit" and abs(span.start - words.index(NOTICE[0])) <= 0 and span.share <= 1


def test_edges(spark):
    rows = [(1, None, "a"), (2, "", "b"), (None, " \t--", "c"), (4, "MIT license", "d"), (4, "MIT license", "d"), (5, "w " * 300_000 + "apache license", "e"), (6, "mit license " * 20_000, "f")]
    df = spark.createDataFrame([(*r, 1, "k", 2, 0.5) for r in rows], "doc_id long, text string, labels string, key int, template string, i int, score double")
    got = li.scan(df).collect()
    assert li.scan(df).columns.count("labels") == 1
    assert sorted((r.doc_id or 0, r.n_words, r.n_base, r.labels, r.key, r.template) for r in got) == sorted(
        (i or 0, *plain(t)[:2], plain(t)[4], 1, "k") for i, t, _ in rows
    )
    assert li.scan(df.filter("false")).count() == 0
    assert [told(r) for r in li.scan(df.filter("doc_id = 4"), keep=["doc_id"], notices=[]).collect()] == [(2, 1, 0, 0, "mit")] * 2


def test_templates_too_many_to_send(spark, monkeypatch):
    monkeypatch.setattr(li, "BROADCAST_WORDS", 0)
    texts = ["the mit license", "nothing", None]
    rows = li.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted((r.doc_id, *told(r)) for r in rows) == [(i, *plain(t)) for i, t in enumerate(texts)]


def test_sql_twin(spark, sf_dir):
    import duckdb

    with duckdb.connect(config={"threads": 4, "memory_limit": "4GB"}) as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
        want = sorted(db.sql(q.oracle_sql()["op11_license_scan"]).fetchall())
    assert sorted(map(tuple, q.op11_license_scan(spark, sf_dir).collect())) == want
