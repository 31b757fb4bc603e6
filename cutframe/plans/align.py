"""SYN rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import align as al
from ..operators import timeline as tl
from ..sources import views as v
from . import query
from .timeline import REEL, r

ENV = "en AS (SELECT clip_id, floor(t / 4)::BIGINT AS n, sum(sig) AS x FROM v_samples GROUP BY 1, 2), ra AS (SELECT clip_id // 2 AS pair, n, x - avg(x) OVER (PARTITION BY clip_id) AS x FROM en WHERE clip_id % 2 = 0), rb AS (SELECT clip_id // 2 AS pair, n, x - avg(x) OVER (PARTITION BY clip_id) AS x FROM en WHERE clip_id % 2 = 1)"


def envelopes(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    e = v.v_samples(spark, sf).groupBy("clip_id", F.floor(F.col("t") / 4).cast("bigint").alias("n")).agg(F.sum("sig").alias("x"))
    e = e.withColumn("pair", F.floor(F.col("clip_id") / 2).cast("bigint"))
    return e.filter("clip_id % 2 = 0").select("pair", "n", "x"), e.filter("clip_id % 2 = 1").select("pair", "n", "x")


@query("syn01_xcorr_offset", "v_samples", f""", {ENV}, lc AS (SELECT a.pair, lag, round(sum(a.x * b.x) / count(*), 9) AS c, count(*) AS n FROM ra a, (SELECT unnest(range(-20, 21)) AS lag) JOIN rb b ON b.pair = a.pair AND b.n = a.n - lag GROUP BY 1, 2 HAVING count(*) >= 8),
nb AS (SELECT l.*, p.c AS c0, q.c AS c2 FROM lc l LEFT JOIN lc p ON p.pair = l.pair AND p.lag = l.lag - 1 LEFT JOIN lc q ON q.pair = l.pair AND q.lag = l.lag + 1),
g AS (SELECT pair, min_by({{'lag': lag, 'c': c, 'c0': c0, 'c2': c2}}, (-abs(c), lag)) AS p, median(abs(c)) AS med FROM nb GROUP BY 1)
SELECT pair, p.lag::INTEGER AS lag, round(p.lag + coalesce(CASE WHEN abs(p.c0 - 2 * p.c + p.c2) > 1e-12 THEN 0.5 * (p.c0 - p.c2) / (p.c0 - 2 * p.c + p.c2) END, 0), 5) AS offset_s, round(abs(p.c) / coalesce(nullif(med, 0), 1), 5) AS confidence FROM g""")
def syn01(spark: SparkSession, sf: str) -> DataFrame:
    return r(al.xcorr_offset(*envelopes(spark, sf), 20), "offset_s", "confidence", digits=5)


@query("syn02_band_offset", "", """WITH f AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS n, count(*) OVER (PARTITION BY label) AS frames, embedding FROM embeddings), s AS (SELECT label, n, frames, b AS band, embedding[b + 1]::DOUBLE AS x FROM f, (SELECT unnest(range(0, 12)) AS b)),
c AS (SELECT a.label AS pair, b.n - a.n AS lag, a.band, abs(sum(a.x * b.x)) AS c FROM s a JOIN s b ON b.label = a.label AND b.band = a.band AND b.n >= a.n AND b.n - a.n <= a.frames - greatest(1, a.frames // 4) WHERE a.n < greatest(1, a.frames // 4) GROUP BY 1, 2, 3), t AS (SELECT pair, lag, round(sum(c), 6) AS s FROM c GROUP BY 1, 2)
SELECT pair, min_by(lag, (-s, lag)) AS lag, max(s) AS best, CASE WHEN count(*) > 1 THEN round((sum(s) - max(s)) / (count(*) - 1), 5) END AS others FROM t GROUP BY 1""")
def syn02(spark: SparkSession, sf: str) -> DataFrame:
    """The first quarter of a label's frames is looked for in all of them."""
    e = v.table(spark, sf, "embeddings").withColumns({"n": F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1, "frames": F.count("*").over(Window.partitionBy("label"))})
    s = e.select(F.col("label").alias("pair"), "n", "frames", F.posexplode(F.slice("embedding", 1, 12)).alias("band", "x")).withColumn("x", F.col("x").cast("double"))
    return r(al.band_offset(s.filter("n < greatest(1, frames div 4)"), s), "others", digits=5)


CARDS = "cd AS (SELECT reel AS job_id, idx, CASE WHEN (reel + idx) % 17 = 0 THEN NULL ELSE sum(duration_s) OVER (PARTITION BY reel ORDER BY idx) - duration_s + CASE WHEN (reel + idx) % 11 = 0 THEN 0.05::DOUBLE ELSE 0 END END AS ofs, CASE WHEN (reel + idx) % 23 = 0 THEN 0 ELSE duration_s END AS dur FROM v_cards)"


@query("syn03_validate_sync_map", "v_cards", f""", {CARDS}, pv AS (SELECT *, last_value(CASE WHEN ofs >= 0 AND dur > 0 THEN ofs + dur END IGNORE NULLS) OVER (PARTITION BY job_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM cd),
jb AS (SELECT o_orderkey AS job_id, CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END AS sv, CASE WHEN o_orderkey % 50 = 0 THEN 'B' ELSE 'A' END AS ra, (o_orderkey % 40) / 1000e0 AS tol, CASE WHEN o_orderkey % 3 = 0 THEN 1.5e0 END AS lag_s FROM orders), n AS (SELECT job_id, count(*) AS n, first(ofs ORDER BY idx) AS f FROM cd GROUP BY 1)
SELECT * FROM (SELECT job_id, unnest([CASE WHEN sv <> 1 THEN 'schema_version' END, CASE WHEN ra <> 'A' THEN 'reference_angle' END, CASE WHEN n IS NULL THEN 'no_cards' END, CASE WHEN tol < 0 OR tol > 0.036 THEN 'tolerance' END, CASE WHEN coalesce(lag_s, f) IS NULL OR coalesce(lag_s, f) <= 0 THEN 'lag' END]) AS problem FROM jb LEFT JOIN n USING (job_id)
UNION ALL SELECT job_id, CASE WHEN ofs IS NULL OR ofs < 0 THEN 'bad_offset' WHEN dur <= 0 THEN 'bad_duration' WHEN abs(ofs - prev) > 0.036 THEN 'discontinuous' END || ':' || idx FROM pv) WHERE problem IS NOT NULL""")
def syn03(spark: SparkSession, sf: str) -> DataFrame:
    c = v.v_cards(spark, sf).withColumn("k", F.col("reel") + F.col("idx"))
    w = Window.partitionBy("reel").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    cards = c.withColumn("o", F.sum("duration_s").over(w) - F.col("duration_s")).select(F.col("reel").alias("job_id"), "idx", F.when(F.col("k") % 17 != 0, F.col("o") + F.when(F.col("k") % 11 == 0, 0.05).otherwise(0.0)).alias("offset"), F.when(F.col("k") % 23 == 0, 0.0).otherwise(F.col("duration_s")).alias("duration_s"))
    key = F.col("o_orderkey")
    jobs = v.table(spark, sf, "orders").select(key.alias("job_id"), F.when(F.col("o_orderstatus") == "P", 2).otherwise(1).alias("schema_version"), F.when(key % 50 == 0, "B").otherwise("A").alias("reference_angle"), (key % 40 / 1000.0).alias("tolerance_s"), F.when(key % 3 == 0, 1.5).alias("lag_s"))
    return al.validate_sync_map(jobs, cards)


@query("syn04_sync_entry", "v_cand", """, x AS (SELECT job_id, candidate_id, anchor - (job_id % 10) * 0.37::DOUBLE AS raw FROM v_cand), y AS (SELECT *, round_even(raw * (30000 / 1001e0), 0) / (30000 / 1001e0) AS sn FROM x)
SELECT job_id, candidate_id, round(CASE WHEN abs(sn - raw) <= 0.036 THEN sn ELSE raw END, 9) + 0e0 AS entry, round(CASE WHEN abs(sn - raw) <= 0.036 THEN sn - raw ELSE 0 END, 9) + 0e0 AS residual FROM y""")
def syn04(spark: SparkSession, sf: str) -> DataFrame:
    e = v.v_cand(spark, sf).withColumn("lag_s", (F.col("job_id") % 10) * 0.37)
    return r(al.sync_entry(e).select("job_id", "candidate_id", "entry", "residual"), "entry", "residual", digits=9)


@query("syn05_entry_coverage", "v_cand v_samples", """, e AS (SELECT job_id AS clip_id, candidate_id, anchor - 3 AS entry, 650e0 AS reel_end FROM v_cand), s AS (SELECT clip_id, t, k % 9 = 0 AS frozen, sig / 100 AS obstruction FROM v_samples WHERE kind <> 'purchase'),
n AS (SELECT e.clip_id, e.candidate_id, e.entry, e.reel_end, min_by({'t': s.t, 'f': s.frozen, 'o': s.obstruction}, (abs(s.t - e.entry), s.t)) AS x FROM e LEFT JOIN s ON s.clip_id = e.clip_id GROUP BY ALL),
z AS (SELECT *, CASE WHEN entry < 0 THEN 'before_reel' WHEN entry > reel_end THEN 'past_reel' WHEN x.t IS NULL THEN 'no_samples' WHEN abs(x.t - entry) > 1 THEN 'no_sample_near' WHEN x.f THEN 'frozen' WHEN x.o >= 0.5 THEN 'obstructed' ELSE 'clean' END AS reason FROM n)
SELECT clip_id, candidate_id, reason, reason = 'clean' AS ok FROM z""")
def syn05(spark: SparkSession, sf: str) -> DataFrame:
    e = v.v_cand(spark, sf).select(F.col("job_id").alias("clip_id"), "candidate_id", (F.col("anchor") - 3).alias("entry"), F.lit(650.0).alias("reel_end"))
    s = v.v_samples(spark, sf).filter("kind <> 'purchase'").select("clip_id", "t", (F.col("k") % 9 == 0).alias("frozen"), (F.col("sig") / 100).alias("obstruction"))
    return al.entry_coverage(e, s).select("clip_id", "candidate_id", "reason", "ok")


@query("syn06_reel_address", "v_cards v_samples", f""", {REEL}, p AS (SELECT clip_id AS reel, event_id, t FROM v_samples) SELECT p.reel, event_id, x.name, round(p.t - v0, 6) AS in_file FROM p ASOF LEFT JOIN reels x ON x.reel = p.reel AND p.t >= x.v0""")
def syn06(spark: SparkSession, sf: str) -> DataFrame:
    p = v.v_samples(spark, sf).select(F.col("clip_id").alias("reel"), "event_id", "t")
    return r(al.reel_address(p, tl.virtual_reel(v.v_cards(spark, sf))).drop("t"), "in_file")


@query("syn07_sync_residuals", "v_cand", "SELECT job_id, event, round(max(abs(timeline_start - start - 0.5)), 9) AS worst, count(*) AS n, max(abs(timeline_start - start - 0.5)) <= 0.036 AS ok FROM v_cand GROUP BY 1, 2")
def syn07(spark: SparkSession, sf: str) -> DataFrame:
    return r(al.sync_residuals(v.v_cand(spark, sf), 0.5), "worst", digits=9)
