"""Nested JSON documents, one per job or clip, in a partitioned sink with a manifest of checksums that readers verify."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scores import NAMES
from .files import overwrite_partitions

#: The weights of the eight scores, in the order of the documents.
WEIGHTS = {"sync": 0.10, "musical": 0.15, "action": 0.20, "quality": 0.10, "info_gain": 0.15, "continuity": 0.10, "novelty": 0.05, "coverage": 0.15}


def nested(rows: DataFrame, keys: list[str], order: list[str], name: str, value: Column) -> DataFrame:
    """keys and `name`: the values of each key's rows as one array, in order."""
    sorted_ = F.array_sort(F.collect_list(F.struct(*order, value.alias("_value"))))
    return rows.groupBy(*keys).agg(F.transform(sorted_, lambda x: x["_value"]).alias(name))


def candidate_documents(cands: DataFrame, policy: dict[str, float]) -> DataFrame:
    """id, doc: a job's policy, weights, score keys, and its events with their candidates.

    cands(job_id, event, candidate_id, angle, action, start, end, timeline_start, timeline_end, scores: a struct of the eight)"""
    one = F.struct(
        F.col("candidate_id").alias("id"), "angle", "action", "start", "end", "timeline_start", "timeline_end", F.round(F.col("timeline_end") - F.col("timeline_start"), 3).alias("duration_s"), F.struct(*(F.col("scores")[n].alias(n) for n in NAMES)).alias("scores")
    )
    events = nested(cands, ["job_id", "event"], ["candidate_id"], "candidates", one)
    event = F.struct(F.format_string("event_%03d", F.col("event").cast("int")).alias("event_id"), "candidates")
    fixed = [F.struct(*(F.lit(v).alias(k) for k, v in policy.items())).alias("policy"), F.struct(*(F.lit(v).alias(k) for k, v in WEIGHTS.items())).alias("weights"), F.array(*map(F.lit, NAMES)).alias("score_keys")]
    return nested(events, ["job_id"], ["event"], "events", event).select(F.col("job_id").alias("id"), F.struct(*fixed, "events").alias("doc"))


def signal_documents(samples: DataFrame, every: float) -> DataFrame:
    """id, doc: a clip's sampling, samples in time order, and summary. samples(clip_id, t, motion, brightness, sharpness, obstruction, frozen)"""
    fields = ["t", "motion", "brightness", "sharpness", "obstruction", "frozen"]
    rows = nested(samples, ["clip_id"], ["t"], "samples", F.struct(*fields))
    told = samples.groupBy("clip_id").agg(
        F.struct(F.lit(every).alias("every_s"), F.min("t").alias("first_sample"), F.max("t").alias("last_sample"), F.count("*").alias("n_samples")).alias("sampling"),
        F.struct(F.avg((~F.col("frozen") & (F.col("obstruction") < 0.5)).cast("double")).alias("clean_frac"), F.count_if("frozen").alias("frozen"), F.count_if(F.col("obstruction") >= 0.5).alias("obstruction")).alias("summary"),
    )
    doc = F.struct("sampling", F.round(F.lit(1.0 / every), 6).alias("fps_sampled"), "samples", "summary")
    return rows.join(told, "clip_id").select(F.col("clip_id").alias("id"), doc.alias("doc"))


def evidence_documents(events: DataFrame, cands: DataFrame, dropped: list[str]) -> DataFrame:
    """id, doc: a job's events with anchor and bare candidates, and the fields withheld from them. events(job_id, event, anchor), cands(job_id, event, candidate_id, angle, start, end)"""
    bare = nested(cands, ["job_id", "event"], ["candidate_id"], "candidates", F.struct(F.col("candidate_id").alias("id"), "angle", "start", "end"))
    rows = events.join(bare, ["job_id", "event"], "left")
    none = F.array().cast(bare.schema["candidates"].dataType)
    event = F.struct(F.format_string("event_%03d", F.col("event").cast("int")).alias("event_id"), "anchor", F.coalesce("candidates", none).alias("candidates"))
    return nested(rows, ["job_id"], ["event"], "events", event).select(F.col("job_id").alias("id"), F.struct("events", F.array(*map(F.lit, dropped)).cast("array<string>").alias("withheld")).alias("doc"))


def provenance_documents(inputs: DataFrame) -> DataFrame:
    """id, doc: what a job was made from: sources in order with their hashes. inputs(job_id, pos, role, path, sha256)"""
    rows = nested(inputs, ["job_id"], ["pos", "path"], "inputs", F.struct("role", "path", "sha256"))
    return rows.select(F.col("job_id").alias("id"), F.struct("inputs", F.size("inputs").alias("n_inputs")).alias("doc"))


def write_documents(docs: DataFrame, path: str, slots: int = 64) -> None:
    """docs(id, doc) as JSON lines by slot of the id, with a manifest of each one's checksum; slots that docs touch are replaced, others stay."""
    line = F.to_json(F.struct(F.col("id").cast("string").alias("id"), "doc"))
    rows = docs.select(F.col("id").cast("string").alias("id"), line.alias("value"), F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(slots)).cast("int").alias("slot"))
    rows.select("value", "slot").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slot").text(f"{path}/documents")
    overwrite_partitions(rows.select("id", F.sha2("value", 256).alias("sha256"), F.octet_length("value").alias("bytes"), "slot"), f"{path}/manifest", "slot")


def read_documents(spark: SparkSession, path: str, doc: str) -> DataFrame:
    """id, state, doc (of type `doc`): what the manifest lists and what lies there: ok, changed, missing or unlisted. A changed document is null."""
    lines = spark.read.schema("value string, slot int").text(f"{path}/documents")
    here = lines.select(F.get_json_object("value", "$.id").alias("id"), "value", F.sha2("value", 256).alias("found"))
    listed = spark.read.schema("id string, sha256 string, bytes int, slot int").parquet(f"{path}/manifest").select("id", "sha256")
    rows = listed.join(here, "id", "full")
    state = F.when(F.col("found").isNull(), "missing").when(F.col("sha256").isNull(), "unlisted").when(F.col("found") != F.col("sha256"), "changed").otherwise("ok")
    body = F.when(state.isin("ok", "unlisted"), F.from_json("value", f"id string, doc {doc}")["doc"])
    return rows.select("id", state.alias("state"), body.alias("doc"))
