"""AUD rows: clicks stand for opportunities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit as au
from ..sources import views as v
from . import query
from .timeline import r

OPPS = "op AS (SELECT clip_id AS job_id, event_id AS opp, t AS t0, t + 2 + k / 20e0 AS t1, t + k / 40e0 AS peak FROM v_samples WHERE kind = 'click')"
BEST = OPPS + """, ov AS (SELECT o.job_id, o.opp, c.candidate_id, c.start, c."end", c.event, round((least(t1, c."end") - greatest(t0, c.start)) / (t1 - t0), 9) AS frac, c.start - t0 AS delta FROM op o JOIN v_cand c ON c.job_id = o.job_id AND greatest(t0, c.start) < least(t1, c."end")),
bg AS (SELECT job_id, opp, min_by({'c': candidate_id, 'f': frac, 'd': delta}, (-frac, start, candidate_id)) AS b, max("end") AS best_exit, string_agg(DISTINCT event::VARCHAR, ',' ORDER BY event::VARCHAR) AS events FROM ov GROUP BY 1, 2),
be AS (SELECT o.*, b.c AS candidate_id, coalesce(b.f, 0) AS frac, b.d AS delta, best_exit, coalesce(events, '') AS events FROM op o LEFT JOIN bg USING (job_id, opp))"""
V1 = "v1 AS (SELECT *, CASE WHEN frac < 0.25 THEN 'MISSED' WHEN frac < 0.8 OR delta < -2 OR delta > 1 THEN 'PARTIAL' ELSE 'COVERED' END AS cls FROM be)"


def opps(spark: SparkSession, sf: str) -> DataFrame:
    s = v.v_samples(spark, sf).filter("kind = 'click'")
    return s.select(F.col("clip_id").alias("job_id"), F.col("event_id").alias("opp"), F.col("t").alias("t0"), (F.col("t") + 2 + F.col("k") / 20.0).alias("t1"), (F.col("t") + F.col("k") / 40.0).alias("peak"))


@query("aud01_event_faces", "v_cand", 'SELECT job_id, event, min(start) AS face_start, max("end") AS face_end, count(*) AS n FROM v_cand GROUP BY 1, 2')
def aud01(spark: SparkSession, sf: str) -> DataFrame:
    return au.event_faces(v.v_cand(spark, sf))


@query("aud02_best_overlap", "v_samples v_cand", f", {BEST} SELECT job_id, opp, candidate_id, round(frac, 6) AS frac, round(delta, 6) AS delta, best_exit, events FROM be")
def aud02(spark: SparkSession, sf: str) -> DataFrame:
    return r(au.best_overlap(opps(spark, sf), v.v_cand(spark, sf)).drop("t0", "t1", "peak"), "frac", "delta")


@query("aud02_nearest_event", "v_samples v_cand", f", {OPPS} SELECT o.job_id, o.opp, o.peak, min_by({{'a': c.anchor, 'e': c.event}}, (abs(c.anchor - o.peak), c.anchor)).a AS near_at, min_by({{'a': c.anchor, 'e': c.event}}, (abs(c.anchor - o.peak), c.anchor)).e AS near_event FROM op o LEFT JOIN v_cand c ON c.job_id = o.job_id GROUP BY 1, 2, 3")
def aud02b(spark: SparkSession, sf: str) -> DataFrame:
    return au.nearest_event(opps(spark, sf), v.v_cand(spark, sf))


def _v1(spark: SparkSession, sf: str) -> DataFrame:
    return au.classify_v1(au.best_overlap(opps(spark, sf), v.v_cand(spark, sf)))


@query("aud03_classify_v1", "v_samples v_cand", f", {BEST}, {V1} SELECT job_id, opp, cls FROM v1")
def aud03(spark: SparkSession, sf: str) -> DataFrame:
    return _v1(spark, sf).select("job_id", "opp", "cls")


@query("aud04_classify_v2", "v_samples v_cand", f""", {OPPS}, m AS (SELECT o.job_id, o.opp, bool_or(abs(c.start - t0) <= 2 AND c."end" >= t1 - 1) AS cov, bool_or(least(t1, c."end") > greatest(t0, c.start)) AS som, bool_or(least(t1, c."end") > greatest(t0, c.start) AND c.start < t0 - 2) AS str, bool_or(least(t1, c."end") > greatest(t0, c.start) AND c.start > t0 + 2) AS late, bool_or(abs(c.start - t0) <= 2 AND c."end" < t1 - 1) AS sx FROM op o JOIN v_cand c ON c.job_id = o.job_id AND greatest(t0 - 2, c.start) <= least(greatest(t1, t0 + 2), c."end") GROUP BY 1, 2)
SELECT o.job_id, o.opp, CASE WHEN cov THEN 'COVERED' WHEN som THEN 'PARTIAL' ELSE 'MISSED' END AS cls, array_to_string(list_filter([CASE WHEN str THEN 'straddle' END, CASE WHEN late AND NOT cov THEN 'only_late' END, CASE WHEN sx AND NOT cov THEN 'short_exit' END], lambda x: x IS NOT NULL), ',') AS flags FROM op o LEFT JOIN m USING (job_id, opp)""")
def aud04(spark: SparkSession, sf: str) -> DataFrame:
    return au.classify_v2(opps(spark, sf), v.v_cand(spark, sf))


@query("aud05_coverage_summary", "v_samples v_cand", f", {BEST}, {V1} SELECT job_id, count(*) AS n, count(*) FILTER (WHERE cls = 'COVERED') AS covered, count(*) FILTER (WHERE cls = 'PARTIAL') AS partial, count(*) FILTER (WHERE cls = 'MISSED') AS missed, round(count(*) FILTER (WHERE cls = 'COVERED') / count(*), 9) AS strict, round((count(*) FILTER (WHERE cls = 'COVERED') + 0.5::DOUBLE * count(*) FILTER (WHERE cls = 'PARTIAL')) / count(*), 9) AS weighted FROM v1 GROUP BY 1")
def aud05(spark: SparkSession, sf: str) -> DataFrame:
    return r(au.coverage_summary(_v1(spark, sf)), "strict", "weighted", digits=9)


UNION = 'iv AS (SELECT job_id, start AS a, "end" AS b FROM v_cand), ib AS (SELECT *, max(b) OVER (PARTITION BY job_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM iv), iu AS (SELECT *, sum(CASE WHEN a > pm OR pm IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY job_id ORDER BY a, b) AS u FROM ib), un AS (SELECT job_id, min(a) AS a, max(b) AS b FROM iu GROUP BY job_id, u)'
HOLES = UNION + """, rg AS (SELECT clip_id AS job_id, 10e0 AS lo, max(t) AS hi FROM v_samples GROUP BY 1), uc AS (SELECT u.job_id, greatest(a, lo) AS a, least(b, hi) AS b, lo, hi FROM un u JOIN rg USING (job_id) WHERE least(b, hi) > greatest(a, lo)),
ho AS (SELECT * FROM (SELECT job_id, coalesce(lag(b) OVER (PARTITION BY job_id ORDER BY a), lo) AS h0, a AS h1 FROM uc UNION ALL SELECT job_id, max(b), any_value(hi) FROM uc GROUP BY 1 UNION ALL SELECT job_id, lo, hi FROM rg WHERE job_id NOT IN (SELECT job_id FROM uc)) WHERE h1 > h0)"""


def _intervals(spark: SparkSession, sf: str) -> DataFrame:
    return v.v_cand(spark, sf).select("job_id", F.col("start").alias("a"), F.col("end").alias("b"))


def _holes(spark: SparkSession, sf: str) -> DataFrame:
    ranges = v.v_samples(spark, sf).groupBy(F.col("clip_id").alias("job_id")).agg(F.max("t").alias("hi")).withColumn("lo", F.lit(10.0))
    return au.holes(_intervals(spark, sf), ranges)


@query("aud06_interval_union", "v_cand", f", {UNION} SELECT job_id, a, b FROM un")
def aud06(spark: SparkSession, sf: str) -> DataFrame:
    return au.interval_union(_intervals(spark, sf))


@query("aud06_holes", "v_cand v_samples", f", {HOLES} SELECT job_id, h0, h1 FROM ho")
def aud06b(spark: SparkSession, sf: str) -> DataFrame:
    return _holes(spark, sf)


@query("aud07_hole_activity", "v_cand v_samples", f""", {HOLES}, g AS (SELECT h.job_id, h0, h1, count(*) AS n, round(avg(sig), 9) AS mean, max(sig) AS peak FROM ho h JOIN v_samples s ON s.clip_id = h.job_id AND s.t BETWEEN h0 AND h1 GROUP BY 1, 2, 3)
SELECT g.job_id, h0, h1, g.n, round(g.mean, 6) AS mean, g.peak, round(count(*) FILTER (WHERE s.sig < g.mean) / count(*), 9) AS mean_rank, round(count(*) FILTER (WHERE s.sig < g.peak) / count(*), 9) AS peak_rank FROM g JOIN v_samples s ON s.clip_id = g.job_id GROUP BY ALL""")
def aud07(spark: SparkSession, sf: str) -> DataFrame:
    s = v.v_samples(spark, sf).select(F.col("clip_id").alias("job_id"), "t", F.col("sig").alias("v"))
    return r(r(au.hole_activity(_holes(spark, sf), s), "mean"), "mean_rank", "peak_rank", digits=9)


@query("aud08_poorly_covered", "v_samples v_cand", f", {BEST} SELECT job_id, opp, round(frac, 6) AS frac FROM be WHERE frac < 0.25")
def aud08(spark: SparkSession, sf: str) -> DataFrame:
    return r(au.poorly_covered(opps(spark, sf), v.v_cand(spark, sf)).select("job_id", "opp", "frac"), "frac")


@query("aud09_opportunity_detail", "v_samples v_cand", f""", {OPPS} SELECT o.job_id, o.opp, c.candidate_id, round(c.start - t0, 6) + 0e0 AS entry, round(c."end" - t1, 6) + 0e0 AS "exit", abs(c.start - t0) <= 1 AS near_onset, abs(c.start - t0) <= 1 AND c."end" - t1 >= -1 AS full_service FROM op o JOIN v_cand c ON c.job_id = o.job_id AND greatest(t0, c.start) < least(t1, c."end")""")
def aud09(spark: SparkSession, sf: str) -> DataFrame:
    return r(au.opportunity_detail(opps(spark, sf), v.v_cand(spark, sf)), "entry", "exit")


@query("aud10_counterpart_peak", "v_samples", f", {OPPS} SELECT o.job_id, o.opp, max(s.sig) AS counterpart FROM op o LEFT JOIN v_samples s ON s.clip_id = o.job_id + 1 AND s.t BETWEEN o.peak - 2 AND o.peak + 2 GROUP BY 1, 2")
def aud10(spark: SparkSession, sf: str) -> DataFrame:
    s = v.v_samples(spark, sf).select((F.col("clip_id") - 1).alias("job_id"), "t", F.col("sig").alias("v"))
    return au.counterpart_peak(opps(spark, sf), s)
