"""Job state and Structured Streaming: each stream has a batch twin that gives the same rows on complete input."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.blocks import islands
from ..sources.store import Catalogue


def ingest_stream(files: DataFrame, store: Catalogue, checkpoint: str) -> StreamingQuery:
    """Ingest a stream of files (path, content or sha, and the catalogue's columns) into a store: what is there now, then stop.

    The store takes each batch once, whatever is replayed after a fault, and each content hash once."""
    if "sha" not in files.columns:
        files = files.withColumn("sha", F.sha2("content", 256))
    return files.writeStream.foreachBatch(lambda batch, number: store.ingest(batch, number)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _stage(retries, most: int):
    return F.when(retries >= most, "quarantined").when(retries > 0, "failed").otherwise("indexed")


def stage_state(log: DataFrame, most: int = 3) -> DataFrame:
    """Per sha: state and retries from a stage log (sha, at, outcome): a success resets, `most` failures since quarantine."""
    ok = F.max(F.when(F.col("outcome") == "success", F.col("at")))
    last = log.groupBy("sha").agg(ok.alias("ok"))
    since = log.join(last, "sha").filter((F.col("outcome") == "failure") & (F.col("ok").isNull() | (F.col("at") > F.col("ok"))))
    n = since.groupBy("sha").agg(F.count("*").alias("retries"))
    rows = last.join(n, "sha", "left").withColumn("retries", F.coalesce("retries", F.lit(0)))
    return rows.select("sha", _stage(F.col("retries"), most).alias("state"), "retries")


class _StageProcessor(StatefulProcessor):
    """Of each hash the time of its last success and those of the failures after it, so that rows may come in any order."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ok = handle.getValueState("ok", "at double")
        self.failures = handle.getListState("failures", "at double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        ok = self.ok.get()[0] if self.ok.exists() else None
        failures = [f[0] for f in self.failures.get()] if self.failures.exists() else []
        for row in rows:
            if row.outcome == "success":
                ok = row.at if ok is None else max(ok, row.at)
            elif row.outcome == "failure":
                failures.append(row.at)
        failures = [f for f in failures if ok is None or f > ok]
        if ok is not None:
            self.ok.update((ok,))
        if failures:
            self.failures.put([(f,) for f in failures])
        else:
            self.failures.clear()
        yield Row(sha=key[0], retries=len(failures))

    def close(self) -> None:
        pass


def stateful(spark: SparkSession) -> None:
    """State of arbitrary shape needs the RocksDB store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def stage_state_stream(log: DataFrame, most: int = 3) -> DataFrame:
    """The stream of stage_state: a row (sha, state, retries) whenever rows of a hash came; its last one is the batch's.

    A hash's failures since its success are its state: few, as a quarantined file isn't tried again."""
    stateful(log.sparkSession)
    kind = log.schema["sha"].dataType.simpleString()
    rows = log.select("sha", F.col("at").cast("double").alias("at"), "outcome").filter("sha is not null and at is not null")
    told = rows.groupBy("sha").transformWithState(_StageProcessor(), f"sha {kind}, retries bigint", outputMode="Update", timeMode="None")
    return told.select("sha", _stage(F.col("retries"), most).alias("state"), "retries")


#: Which status may follow which.
LEGAL = {"proposed": "approved", "approved": "executing", "executing": "done,failed", "failed": "approved", "done": ""}


def job_state(events: DataFrame, jobs: DataFrame, flags: DataFrame, start: str = "proposed") -> DataFrame:
    """Per job of events(job_id, at, status, error): its status after folding them in time order, with what held it up.

    jobs(job_id, project), project null where a job has none; flags(project, at): when a project's preview was approved. Approval and start of a job
    with a project are refused before its flag; a move that may not follow the status is ignored. error is the text of the last failure, none after done.
    Beside the status stands whether the job is blocked: proposed or approved, of a project without a flag.
    """
    e = F.array_sort(F.collect_list(F.struct("at", "status", "error")))
    table = F.map_from_arrays(F.array(*(F.lit(k) for k in LEGAL)), F.array(*(F.split(F.lit(x), ",") for x in LEGAL.values())))
    zero = F.struct(F.lit(start).alias("status"), F.lit(0).alias("ignored"), F.lit(0).alias("refused"), F.lit(None).cast("string").alias("error"))

    def step(acc, x):
        keep = lambda **new: F.struct(*(new.get(c, acc[c]).alias(c) for c in ("status", "ignored", "refused", "error")))
        early = x["status"].isin("approved", "executing") & F.col("_project").isNotNull() & ~F.coalesce(x["at"] >= F.col("_flag"), F.lit(False))
        text = F.when(x["status"] == "failed", x["error"]).when(x["status"] != "done", acc["error"])
        return F.when(~F.array_contains(table[acc["status"]], x["status"]), keep(ignored=acc["ignored"] + 1)).when(early, keep(refused=acc["refused"] + 1)).otherwise(keep(status=x["status"], error=text))

    ready = flags.filter("project is not null").groupBy("project").agg(F.min("at").alias("_flag"))
    own = jobs.groupBy("job_id").agg(F.max("project").alias("_project")).join(ready, F.col("_project") == F.col("project"), "left").select("job_id", "_project", "_flag")
    rows = events.groupBy("job_id").agg(e.alias("_events")).join(own, "job_id", "left").withColumn("s", F.aggregate("_events", zero, step))
    blocked = F.col("s.status").isin("proposed", "approved") & F.col("_project").isNotNull() & F.col("_flag").isNull()
    return rows.select("job_id", "s.status", blocked.alias("blocked"), "s.error", "s.ignored", "s.refused")


def job_listing(state: DataFrame, status: str | None = None) -> DataFrame:
    """Jobs of a state, or all, the newest first."""
    return (state if status is None else state.filter(F.col("status") == status)).orderBy(F.desc("job_id"))


def config_hash(*fields: str):
    """Eight characters of the SHA-1 of the fields in canonical order."""
    return F.substring(F.sha1(F.concat_ws("|", *(F.concat(F.lit(f"{f}="), F.coalesce(F.col(f).cast("string"), F.lit("~"))) for f in sorted(fields)))), 1, 8)


def approvals(log: DataFrame, configs: DataFrame) -> DataFrame:
    """Per job (configs: job_id, hash): the latest approval (log: job_id, at, hash), and whether the configuration changed since."""
    latest = log.groupBy("job_id").agg(F.max_by("hash", "at").alias("approved_hash"), F.max("at").alias("approved_at"))
    rows = configs.join(latest, "job_id", "left")
    return rows.select("job_id", "hash", "approved_hash", F.when(F.col("approved_hash").isNull(), "unapproved").when(F.col("approved_hash") == F.col("hash"), "clean").otherwise("dirty").alias("state"))


def liveness(progress: DataFrame, now: DataFrame, quiet: float, hung: float) -> DataFrame:
    """Per job: alive, quiet or hung by the age of its last progress (job_id, t) at now (one row, column now)."""
    g = progress.groupBy("job_id").agg(F.max("t").alias("last")).crossJoin(F.broadcast(now.limit(1)))
    age = F.col("now") - F.col("last")
    return g.select("job_id", age.alias("age"), F.when(age >= hung, "hung").when(age >= quiet, "quiet").otherwise("alive").alias("state"))


class _LivenessProcessor(StatefulProcessor):
    """Of each job its last progress; timers turn it quiet, then hung, when nothing more comes."""

    def __init__(self, quiet_ms: int, hung_ms: int):
        self.after = (("quiet", quiet_ms), ("hung", hung_ms))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "since bigint, last double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last, ended = None, False
        for row in rows:
            last = row.t if last is None else max(last, row.t)
            ended |= bool(row.ended)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if ended:
            self.seen.clear()
            yield Row(job_id=key[0], state="ended", last=last)
            return
        now = timerValues.getCurrentProcessingTimeInMs()
        before = self.seen.get()[1] if self.seen.exists() else last
        self.seen.update((now, max(before, last)))
        for _, ms in self.after:
            self.handle.registerTimer(now + ms)
        yield Row(job_id=key[0], state="alive", last=max(before, last))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.seen.exists():
            since, last = self.seen.get()
            age = expiredTimerInfo.getExpiryTimeInMs() - since
            state = [name for name, ms in self.after if age >= ms]
            if state:
                yield Row(job_id=key[0], state=state[-1], last=last)

    def close(self) -> None:
        pass


def liveness_stream(progress: DataFrame, quiet_ms: int, hung_ms: int) -> DataFrame:
    """The stream of liveness over progress(job_id, t, ended): a row (job_id, state, last) when a job makes progress (alive), when none came
    for quiet_ms or hung_ms of the clock (quiet, hung; no new row is needed for that), and when it ends, which forgets it."""
    stateful(progress.sparkSession)
    kind = progress.schema["job_id"].dataType.simpleString()
    rows = progress.select("job_id", F.col("t").cast("double").alias("t"), "ended").filter("job_id is not null and t is not null")
    return rows.groupBy("job_id").transformWithState(_LivenessProcessor(quiet_ms, hung_ms), f"job_id {kind}, state string, last double", outputMode="Update", timeMode="ProcessingTime")


def activity_sessions(events: DataFrame, gap: str, delay: str | None = None) -> DataFrame:
    """Bursts per clip closed by a gap (events: clip_id, ts, v), on a stream or a batch; late rows beyond the delay are dropped."""
    rows = events.withWatermark("ts", delay) if delay else events
    g = rows.groupBy("clip_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"), F.sum("v").alias("v"))
    return g.select("clip_id", F.col("w.start").alias("start_ts"), F.col("w.end").alias("end_ts"), "n", "v")


def sessions_by_islands(events: DataFrame, gap_us: int) -> DataFrame:
    """The batch twin of activity_sessions: gaps and islands over event times."""
    us = F.unix_micros("ts")
    w = Window.partitionBy("clip_id").orderBy("ts")
    s = islands(events.withColumn("us", us), ["clip_id"], ["ts"], F.col("us") - F.lag("us").over(w) > gap_us, "s")
    g = s.groupBy("clip_id", "s").agg(F.min("us").alias("a"), F.max("us").alias("b"), F.count("*").alias("n"), F.sum("v").alias("v"))
    return g.select("clip_id", F.timestamp_micros("a").alias("start_ts"), F.timestamp_micros(F.col("b") + gap_us).alias("end_ts"), "n", "v")


def window_rollup(events: DataFrame, size: str, slide: str | None = None, delay: str | None = None) -> DataFrame:
    """RMS, peak and count of v per clip and tumbling or sliding window, on a stream or a batch."""
    rows = events.withWatermark("ts", delay) if delay else events
    g = rows.groupBy("clip_id", F.window("ts", size, slide).alias("w") if slide else F.window("ts", size).alias("w"))
    g = g.agg(F.count("*").alias("n"), F.sqrt(F.avg(F.col("v") * F.col("v"))).alias("rms"), F.max("v").alias("peak"))
    return g.select("clip_id", F.col("w.start").alias("start_ts"), F.col("w.end").alias("end_ts"), "n", "rms", "peak")


def event_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """A file stream of events with columns clip_id, ts, v."""
    return spark.readStream.schema(schema).parquet(path)
