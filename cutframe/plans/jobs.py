"""STR rows: batch twins as queries; tests hold the streams against them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import files
from ..sources import views as v
from ..sources.store import Catalogue
from ..streaming import jobs
from . import query
from .timeline import r


STAGE_SQL = ", l AS (SELECT clip_id AS sha, max(t) FILTER (WHERE kind = 'purchase') AS ok FROM v_samples WHERE kind IN ('error', 'purchase') GROUP BY 1), n AS (SELECT sha, (SELECT count(*) FROM v_samples s WHERE s.clip_id = l.sha AND kind = 'error' AND (ok IS NULL OR s.t > ok)) AS retries FROM l) SELECT sha, CASE WHEN retries >= 3 THEN 'quarantined' WHEN retries > 0 THEN 'failed' ELSE 'indexed' END AS state, retries FROM n"


@query("str01_ingest_once", "", """WITH f AS (SELECT 'c/' || doc_id AS path, sha256(CASE WHEN doc_id % 7 = 0 THEN 'same' || doc_id % 70 ELSE text END) AS sha, n_chars AS size, doc_id % 3 AS batch FROM documents WHERE text IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY sha ORDER BY batch, path) AS n FROM f) SELECT path, sha, size, CASE WHEN batch = 0 THEN 'first' END AS tags FROM o WHERE n = 1""")
def str01(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches of files, the second given twice, the first once more under another number: every content comes in once, and what is in stays."""
    d = v.table(spark, sf, "documents").filter("text is not null")
    content = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("same"), (F.col("doc_id") % 70).cast("string"))).otherwise(F.col("text"))
    rows = d.select(F.concat(F.lit("c/"), F.col("doc_id").cast("string")).alias("path"), F.sha2(content, 256).alias("sha"), F.col("n_chars").alias("size"), (F.col("doc_id") % 3).alias("batch"), F.when(F.col("doc_id") % 3 == 0, "first").alias("tags"))
    store = Catalogue(spark, files.scratch(spark, "catalogue"), slots=8).create()
    for number, part in ((0, 0), (1, 1), (1, 1), (2, 2), (3, 0)):
        store.ingest(rows.filter(F.col("batch") == part).drop("batch"), number)
    return store.files().select("path", "sha", "size", "tags")


@query("str02_stage_state", "v_samples", STAGE_SQL)
def str02(spark: SparkSession, sf: str) -> DataFrame:
    s = v.v_samples(spark, sf).filter("kind in ('error', 'purchase')")
    return jobs.stage_state(s.select(F.col("clip_id").alias("sha"), F.col("t").alias("at"), F.when(F.col("kind") == "error", "failure").otherwise("success").alias("outcome")))


@query("str02_stage_state_stream", "v_samples", STAGE_SQL)
def str02b(spark: SparkSession, sf: str) -> DataFrame:
    """The stream over the event files, to its end; its last row of each hash."""
    e = files.table_stream(spark, sf, "events")
    log = e.filter("event_type in ('error', 'purchase')").select(F.col("user_id").alias("sha"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), F.when(F.col("event_type") == "error", "failure").otherwise("success").alias("outcome"))
    out, at = files.scratch(spark, "stage-states"), files.scratch(spark, "stage-checkpoint")
    write = lambda rows, number: files.overwrite_partitions(rows.withColumn("batch", F.lit(number)), out, "batch")
    jobs.stage_state_stream(log).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", at).trigger(availableNow=True).start().awaitTermination()
    last = F.row_number().over(Window.partitionBy("sha").orderBy(F.desc("batch")))
    rows = spark.read.schema("sha bigint, state string, retries bigint, batch bigint").parquet(out)
    return rows.withColumn("last", last).filter("last = 1").select("sha", "state", "retries")


@query("str03_job_state", "v_samples", """, e AS (SELECT clip_id AS job_id, t, row_number() OVER (PARTITION BY clip_id ORDER BY t) AS o, CASE kind WHEN 'signup' THEN 'approved' WHEN 'view' THEN 'executing' WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'failed' ELSE 'proposed' END AS status, CASE WHEN kind = 'error' THEN 'e' || event_id END AS error, clip_id % 3 <> 0 AS project, CASE WHEN clip_id % 2 = 0 THEN 100 END AS flag FROM v_samples),
w AS (SELECT job_id, 0::BIGINT AS o, 'proposed' AS status, 0 AS ignored, 0 AS refused, NULL::VARCHAR AS error FROM (SELECT DISTINCT job_id FROM e)
 UNION ALL SELECT job_id, o, CASE how WHEN 'taken' THEN nx ELSE status END, ignored + (how = 'ignored')::INT, refused + (how = 'refused')::INT, CASE WHEN how <> 'taken' THEN error WHEN nx = 'failed' THEN ne WHEN nx <> 'done' THEN error END
 FROM (SELECT w.*, e.o AS o, e.status AS nx, e.error AS ne, CASE WHEN NOT ((w.status = 'proposed' AND e.status = 'approved') OR (w.status = 'approved' AND e.status = 'executing') OR (w.status = 'executing' AND e.status IN ('done', 'failed')) OR (w.status = 'failed' AND e.status = 'approved')) THEN 'ignored' WHEN e.status IN ('approved', 'executing') AND project AND coalesce(t < flag, true) THEN 'refused' ELSE 'taken' END AS how FROM (SELECT * EXCLUDE (o), o AS o0 FROM w) w JOIN e ON e.job_id = w.job_id AND e.o = w.o0 + 1)),
f AS (SELECT job_id, max_by(struct_pack(status, ignored, refused, error), o) AS s FROM w GROUP BY 1)
SELECT job_id, s.status AS status, s.status IN ('proposed', 'approved') AND job_id % 3 <> 0 AND job_id % 2 = 1 AS blocked, s.error AS error, s.ignored AS ignored, s.refused AS refused FROM f""")
def str03(spark: SparkSession, sf: str) -> DataFrame:
    s, kind = v.v_samples(spark, sf), F.col("kind")
    status = F.when(kind == "signup", "approved").when(kind == "view", "executing").when(kind == "purchase", "done").when(kind == "error", "failed").otherwise("proposed")
    e = s.select(F.col("clip_id").alias("job_id"), F.col("t").alias("at"), status.alias("status"), F.when(kind == "error", F.concat(F.lit("e"), F.col("event_id").cast("string"))).alias("error"))
    own = e.select("job_id", F.when(F.col("job_id") % 3 != 0, F.concat(F.lit("p"), F.col("job_id").cast("string"))).alias("project")).distinct()
    return jobs.job_state(e, own, own.filter("job_id % 2 = 0").select("project", F.lit(100).alias("at")))


@query("str04_approvals", "v_samples", """, c AS (SELECT clip_id AS job_id, substr(sha1('k=' || max_by(k, t) || '|n=' || count(*)), 1, 8) AS hash FROM v_samples GROUP BY 1), l AS (SELECT s.clip_id AS job_id, t, CASE WHEN k % 2 = 0 THEN c.hash ELSE 'old' || k END AS h FROM v_samples s JOIN c ON c.job_id = s.clip_id WHERE kind = 'signup' AND s.clip_id % 9 <> 0), a AS (SELECT job_id, max_by(h, t) AS approved_hash FROM l GROUP BY 1)
SELECT c.job_id, c.hash, approved_hash, CASE WHEN approved_hash IS NULL THEN 'unapproved' WHEN approved_hash = hash THEN 'clean' ELSE 'dirty' END AS state FROM c LEFT JOIN a USING (job_id)""")
def str04(spark: SparkSession, sf: str) -> DataFrame:
    s = v.v_samples(spark, sf).withColumnRenamed("clip_id", "job_id")
    c = s.groupBy("job_id").agg(F.max_by("k", "t").alias("k"), F.count("*").alias("n")).select("job_id", jobs.config_hash("k", "n").alias("hash"))
    log = s.filter("kind = 'signup' and job_id % 9 <> 0").join(c, "job_id").select("job_id", F.col("t").alias("at"), F.when(F.col("k") % 2 == 0, F.col("hash")).otherwise(F.concat(F.lit("old"), F.col("k").cast("string"))).alias("hash"))
    return jobs.approvals(log, c)


@query("str05_liveness", "v_samples", "SELECT clip_id AS job_id, round((SELECT max(t) FROM v_samples) - max(t), 6) AS age, CASE WHEN (SELECT max(t) FROM v_samples) - max(t) >= 20 THEN 'hung' WHEN (SELECT max(t) FROM v_samples) - max(t) >= 8 THEN 'quiet' ELSE 'alive' END AS state FROM v_samples GROUP BY 1")
def str05(spark: SparkSession, sf: str) -> DataFrame:
    s = v.v_samples(spark, sf)
    return r(jobs.liveness(s.withColumnRenamed("clip_id", "job_id"), s.agg(F.max("t").alias("now")), 8.0, 20.0), "age")


def stream_rows(spark: SparkSession, sf: str) -> DataFrame:
    return v.table(spark, sf, "events").select(F.col("user_id").alias("clip_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("v"))


def _us(df: DataFrame, *more: str) -> DataFrame:
    return df.select("clip_id", F.unix_micros("start_ts").alias("start_us"), F.unix_micros("end_ts").alias("end_us"), *more)


@query("str06_activity_sessions", "", """WITH e AS (SELECT user_id AS clip_id, epoch_us(ts) AS us, value AS v FROM events), f AS (SELECT *, CASE WHEN us - lag(us) OVER w <= 28800000000 THEN 0 ELSE 1 END AS new FROM e WINDOW w AS (PARTITION BY clip_id ORDER BY us)), i AS (SELECT *, sum(new) OVER (PARTITION BY clip_id ORDER BY us) AS s FROM f)
SELECT clip_id, min(us) AS start_us, max(us) + 28800000000 AS end_us, count(*) AS n, round(sum(v), 6) AS v FROM i GROUP BY clip_id, s""")
def str06(spark: SparkSession, sf: str) -> DataFrame:
    return r(_us(jobs.activity_sessions(stream_rows(spark, sf), "8 hours"), "n", "v"), "v")


@query("str06_sessions_by_islands", "", """WITH e AS (SELECT user_id AS clip_id, epoch_us(ts) AS us, value AS v FROM events), f AS (SELECT *, CASE WHEN us - lag(us) OVER w <= 28800000000 THEN 0 ELSE 1 END AS new FROM e WINDOW w AS (PARTITION BY clip_id ORDER BY us)), i AS (SELECT *, sum(new) OVER (PARTITION BY clip_id ORDER BY us) AS s FROM f)
SELECT clip_id, min(us) AS start_us, max(us) + 28800000000 AS end_us, count(*) AS n, round(sum(v), 6) AS v FROM i GROUP BY clip_id, s""")
def str06b(spark: SparkSession, sf: str) -> DataFrame:
    return r(_us(jobs.sessions_by_islands(stream_rows(spark, sf), 8 * 3600 * 10**6), "n", "v"), "v")


@query("str07_window_rollup", "", "WITH e AS (SELECT user_id AS clip_id, epoch_us(ts) AS us, value AS v FROM events), x AS (SELECT clip_id, v, unnest([us // 21600000000 * 21600000000, us // 21600000000 * 21600000000 - 21600000000]) AS start_us FROM e) SELECT clip_id, start_us, start_us + 43200000000 AS end_us, count(*) AS n, round(sqrt(avg(v * v)), 6) AS rms, max(v) AS peak FROM x GROUP BY 1, 2")
def str07(spark: SparkSession, sf: str) -> DataFrame:
    return r(_us(jobs.window_rollup(stream_rows(spark, sf), "12 hours", "6 hours"), "n", "rms", "peak"), "rms")
