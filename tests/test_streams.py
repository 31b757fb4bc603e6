"""Streams against their batch twins, and sinks and sources that write files."""

from __future__ import annotations

import hashlib
import json
import time

import pytest
from pyspark.sql import functions as F

from cutframe.plans.jobs import stream_rows
from cutframe.sources import artifacts, catalog
from cutframe.sources import store as store_module
from cutframe.sources import views as v
from cutframe.sources.store import Catalogue
from cutframe.streaming import jobs


@pytest.fixture()
def parts(spark, sf_dir, tmp_path):
    """Events in time order, in three files, with a last far-off row that pushes the watermark past all others."""
    rows = stream_rows(spark, sf_dir)
    for lo in range(3):
        rows.filter(F.pmod(F.floor(F.unix_micros("ts") / 86400000000 / 10), F.lit(3)) == lo).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return rows, str(tmp_path / "in")


def collected(spark, df, name):
    q = df.writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    return {tuple(r) for r in spark.table(name).collect()}


def test_window_rollup_stream_equals_batch(spark, parts):
    rows, path = parts
    stream = jobs.window_rollup(jobs.event_stream(spark, path, rows.schema), "12 hours", delay="400 days")
    exact = ["clip_id", "start_ts", "end_ts", "n", "peak"]
    batch = {tuple(r) for r in jobs.window_rollup(rows, "12 hours").select(*exact).collect()}
    assert collected(spark, stream.select(*exact), "rollup") == batch


def test_sessions_stream_equals_islands(spark, parts):
    rows, path = parts
    stream = jobs.activity_sessions(jobs.event_stream(spark, path, rows.schema), "8 hours", delay="400 days")
    exact = ["clip_id", "start_ts", "end_ts", "n"]
    batch = {tuple(r) for r in jobs.sessions_by_islands(rows, 8 * 3600 * 10**6).select(*exact).collect()}
    assert collected(spark, stream.select(*exact), "sessions") == batch


def test_ingest_once(spark, tmp_path):
    """Each content once, over batches, runs and replays; tags stay; a path's new content frees its old hash."""
    store = Catalogue(spark, str(tmp_path / "store"), slots=4).create()

    def run(rows, name):
        spark.createDataFrame(rows, "path string, content string, size long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        files = spark.readStream.schema("path string, content string, size long").parquet(str(tmp_path / "in"))
        jobs.ingest_stream(files, store, str(tmp_path / name)).awaitTermination(120)
        return sorted((r.path, r.size, r.tags) for r in store.files().collect())

    first = [("a", 1, None), ("b", 2, None)]
    assert run([("a", "x", 1), ("b", "y", 2), ("c", "x", 3), (None, "z", 4), ("d", None, 5)], "ck") == first
    assert run([("e", "y", 6)], "ck") == first and store.ledger().count() == 2
    files = spark.createDataFrame([("a", "sx", 1)], "path string, sha string, size long")
    assert store.ingest(files, 7) and not store.ingest(files, 7)  # new content at an old path
    assert store.ingest(spark.createDataFrame([("c", jobs_sha("x"), 3)], "path string, sha string, size long"), 8)  # its old hash is free again
    assert sorted((r.path, r.sha) for r in store.files().collect()) == [("a", "sx"), ("b", jobs_sha("y")), ("c", jobs_sha("x"))]
    store.ingest(spark.createDataFrame([("b", "new", 9, "t", "n")], "path string, sha string, size long, tags string, notes string"), 9)
    assert [(r.size, r.tags) for r in store.files().filter("path = 'b'").collect()] == [(9, None)]
    assert store.ingest(files.filter("false"), 10) and store.files().count() == 3


def jobs_sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_batch_that_broke_off(spark, tmp_path, monkeypatch):
    """A batch whose hashes or ledger entry were never written is given again, and ends in the same state."""
    rows = spark.createDataFrame([(f"p{i}", f"h{i % 5}", i) for i in range(12)], "path string, sha string, size long")
    want = None
    for stop in (None, "hashes", "ledger"):
        store = Catalogue(spark, str(tmp_path / f"store-{stop}"), slots=3).create()
        if stop:
            real = store_module.overwrite_partitions

            def broken(df, path, *by, real=real, stop=stop):
                if path.endswith(stop):
                    raise OSError("lost")
                real(df, path, *by)

            with monkeypatch.context() as m:
                m.setattr(store_module, "overwrite_partitions", broken)
                with pytest.raises(OSError):
                    store.ingest(rows, 0)
        assert store.ingest(rows, 0)
        got = sorted(map(tuple, store.files().collect()))
        want = want or got
        assert got == want and len(got) == 5


def log_files(spark, sf_dir, at, parts):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").filter("event_type in ('error', 'purchase')")
    log = events.select(F.col("user_id").alias("sha"), F.unix_micros(F.col("ts").cast("timestamp")).cast("double").alias("at"), F.when(F.col("event_type") == "error", "failure").otherwise("success").alias("outcome"))
    for lo in parts:
        log.filter(F.pmod(F.xxhash64("sha", "at"), F.lit(4)) == lo).coalesce(1).write.mode("append").parquet(at)
    return log


def test_stage_state_stream_over_a_restart(spark, sf_dir, tmp_path):
    """Rows in no order, in two runs from one checkpoint: the last states are the batch's."""
    at, told = str(tmp_path / "in"), {}

    def keep(rows, number):
        told.update({r.sha: (r.state, r.retries) for r in rows.collect()})

    for parts in ((2, 0), (3, 1)):
        log = log_files(spark, sf_dir, at, parts)
        stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(at)
        query = jobs.stage_state_stream(stream).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "ck"))
        query.trigger(availableNow=True).start().awaitTermination(300)
    assert told == {r.sha: (r.state, r.retries) for r in jobs.stage_state(log).collect()}
    assert {state for state, _ in told.values()} >= {"indexed", "failed"}


def test_a_silent_job_turns_quiet_then_hung(spark, tmp_path):
    at, told = str(tmp_path / "in"), []
    schema = "job_id string, t double, ended boolean"

    def more(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(at)

    more(("silent", 1.0, False), ("done", 1.0, False), ("done", 2.0, True), (None, 1.0, False))
    stream = spark.readStream.schema(schema).parquet(at)
    query = jobs.liveness_stream(stream, 1500, 6000).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "ck"))
    query = query.foreachBatch(lambda rows, number: told.extend((r.job_id, r.state) for r in rows.collect())).start()
    try:
        end = time.time() + 150
        while ("silent", "hung") not in told and time.time() < end:
            time.sleep(0.5)
        more(("silent", 3.0, False))
        while told.count(("silent", "alive")) < 2 and time.time() < end:
            time.sleep(0.5)
    finally:
        query.stop()
    silent = [state for job, state in told if job == "silent"]
    assert silent[:4] == ["alive", "quiet", "hung", "alive"]
    assert [state for job, state in told if job == "done"] == ["ended"]


def test_inventory_skips_hidden_and_other_files(spark, tmp_path):
    for name in ("a.mov", "sub/b.MP4", "sub/._b.mp4", ".hidden.mov", "c.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"12345")
    got = catalog.scan_inventory(spark, str(tmp_path), ["mov", "mp4"]).collect()
    assert sorted(r.path.rsplit("/", 1)[1] for r in got) == ["a.mov", "b.MP4"]
    assert {r.size for r in got} == {5}


def test_artifact_round_trip(spark, sf_dir, tmp_path):
    cuts = v.v_cuts(spark, sf_dir).select("job_id", "pos", "cut_id", "angle")
    catalog.write_artifact(cuts, ["job_id"], ["pos"], str(tmp_path / "out"))
    back = [json.loads(line) for p in (tmp_path / "out").glob("*.json") for line in p.read_text().splitlines()]
    assert sum(len(d["rows"]) for d in back) == cuts.count()
    assert all([x["pos"] for x in d["rows"]] == list(range(len(d["rows"]))) for d in back)


def test_documents_are_verified(spark, tmp_path):
    inputs = spark.createDataFrame([(j, k, "a", f"p{k}", "h") for j in range(6) for k in range(3)], "job_id int, pos int, role string, path string, sha256 string")
    path, kind = str(tmp_path / "docs"), "struct<inputs:array<struct<role:string,path:string,sha256:string>>,n_inputs:int>"
    artifacts.write_documents(artifacts.provenance_documents(inputs), path, slots=3)
    back = artifacts.read_documents(spark, path, kind).collect()
    assert {(r.id, r.state, r.doc.n_inputs, tuple(x.path for x in r.doc.inputs)) for r in back} == {(str(j), "ok", 3, ("p0", "p1", "p2")) for j in range(6)}
    lines = {p: p.read_text() for p in (tmp_path / "docs" / "documents").rglob("part-*.txt")}
    for p, text in lines.items():
        p.write_text("".join(line.replace("p0", "p9") if '"id":"0"' in line else "" if '"id":"1"' in line else line for line in text.splitlines(True)) + '{"id":"77","doc":{"n_inputs":1}}\n' * (p == min(lines)))
        (p.parent / f".{p.name}.crc").unlink(missing_ok=True)
    states = {r.id: r.state for r in artifacts.read_documents(spark, path, kind).collect()}
    assert states == {"0": "changed", "1": "missing", "77": "unlisted"} | {str(j): "ok" for j in range(2, 6)}
    artifacts.write_documents(artifacts.provenance_documents(inputs.filter("job_id < 2")), path, slots=3)  # the others' slots stay, or go with theirs
    assert all(r.state in ("ok", "unlisted") for r in artifacts.read_documents(spark, path, kind).filter("id in ('0', '1')").collect())
