"""MUS rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import music
from ..sources import views as v
from . import query

BARS = "bars AS (SELECT clip_id, row_number() OVER (PARTITION BY clip_id ORDER BY t) - 1 AS bar, t AS start, coalesce(lead(t) OVER (PARTITION BY clip_id ORDER BY t), final) AS \"end\" FROM (SELECT b.*, max(t) OVER (PARTITION BY clip_id) AS final FROM v_beats b) WHERE i % 4 = 0)"
PHRASES = "phrases AS (SELECT clip_id, bar // 8 AS phrase, min(start) AS start, max_by(\"end\", bar) AS \"end\", count(*) AS bars, min(bar) AS start_bar, count(*) = 8 AS complete FROM bars GROUP BY 1, 2)"


def _near(points: str, cols: str, at: str, grid: str, g: str, name: str) -> str:
    """SQL: nearest grid value, the earlier of two."""
    return f"(SELECT {cols}, min_by(g.{g}, (abs(g.{g} - p.{at}), g.{g})) AS {name} FROM {points} p LEFT JOIN {grid} g ON g.clip_id = p.clip_id GROUP BY ALL)"


@query("mus01_bpm", "v_beats", """SELECT clip_id, n, 60 / gaps[len(gaps) // 2 + 1] AS bpm FROM (
  SELECT clip_id, count(*) AS n, list_sort(list(gap) FILTER (WHERE gap > 0)) AS gaps FROM (
    SELECT clip_id, lead(t) OVER (PARTITION BY clip_id ORDER BY t) - t AS gap FROM v_beats) GROUP BY 1) WHERE n > 4 AND len(gaps) > 0""")
def mus01(spark: SparkSession, sf: str) -> DataFrame:
    return music.bpm(v.v_beats(spark, sf))


@query("mus02_bars", "v_beats", f', {BARS} SELECT clip_id, bar, start AS start_s, "end" AS end_s FROM bars')
def mus02(spark: SparkSession, sf: str) -> DataFrame:
    return music.bars(v.v_beats(spark, sf)).select("clip_id", "bar", F.col("start").alias("start_s"), F.col("end").alias("end_s"))


@query("mus03_phrases", "v_beats", f', {BARS}, {PHRASES} SELECT clip_id, phrase, start AS start_s, "end" AS end_s, bars, start_bar, complete FROM phrases')
def mus03(spark: SparkSession, sf: str) -> DataFrame:
    return music.phrases(music.bars(v.v_beats(spark, sf))).withColumnsRenamed({"start": "start_s", "end": "end_s"})


def _points(spark: SparkSession, sf: str) -> DataFrame:
    return v.v_cand(spark, sf).select(F.col("job_id").alias("clip_id"), "candidate_id", F.col("anchor").alias("t"))


@query("mus04_musical_context", "v_beats v_cand", f""", {BARS}, {PHRASES}, p AS (SELECT job_id AS clip_id, candidate_id, anchor AS t FROM v_cand),
a AS (SELECT p.clip_id, p.candidate_id, p.t, min_by(g.t, (abs(g.t - p.t), g.t)) AS nb FROM p LEFT JOIN v_beats g ON g.clip_id = p.clip_id GROUP BY ALL),
d AS (SELECT a.clip_id, a.candidate_id, a.t, a.nb, min_by(g.start, (abs(g.start - a.t), g.start)) AS nd FROM a LEFT JOIN bars g ON g.clip_id = a.clip_id GROUP BY ALL)
SELECT d.clip_id, candidate_id, d.t, d.t - nb AS beat_delta, d.t - nd AS downbeat_delta, f.phrase, b.bar - f.start_bar AS bars_in, abs(d.t - nd) <= 1e-3 AS at_downbeat, abs(d.t - f.start) <= 1e-3 AS at_phrase
FROM d ASOF LEFT JOIN phrases f ON d.clip_id = f.clip_id AND d.t >= f.start ASOF LEFT JOIN bars b ON d.clip_id = b.clip_id AND d.t >= b.start""")
def mus04(spark: SparkSession, sf: str) -> DataFrame:
    beats = v.v_beats(spark, sf)
    bars = music.bars(beats)
    return music.musical_context(_points(spark, sf), beats, bars, music.phrases(bars))


@query("mus05_musical_score", "v_beats v_cand", f""", {BARS}, {PHRASES}, p AS (SELECT job_id AS clip_id, candidate_id, anchor AS t FROM v_cand),
s AS (SELECT p.clip_id, p.candidate_id, p.t, (SELECT min(abs(g.t - p.t)) FROM v_beats g WHERE g.clip_id = p.clip_id) AS x, (SELECT min(abs(g.start - p.t)) FROM bars g WHERE g.clip_id = p.clip_id) AS y, (SELECT min(abs(g.start - p.t)) FROM phrases g WHERE g.clip_id = p.clip_id) AS z FROM p)
SELECT clip_id, candidate_id, t, round(greatest(coalesce(greatest(0, 1 - x / 0.12::DOUBLE) * 0.75::DOUBLE, 0), coalesce(greatest(0, 1 - y / 0.25::DOUBLE) * 0.9::DOUBLE, 0), coalesce(greatest(0, 1 - z / 0.5::DOUBLE), 0)), 9) AS musical FROM s""")
def mus05(spark: SparkSession, sf: str) -> DataFrame:
    beats = v.v_beats(spark, sf)
    bars = music.bars(beats)
    grids = {"beat": beats, "down": bars.withColumnRenamed("start", "t"), "phrase": music.phrases(bars).withColumnRenamed("start", "t")}
    return music.musical_score(_points(spark, sf), grids).withColumn("musical", F.round("musical", 9))


@query("mus06_quantize", "v_cuts v_beats", """, e AS (SELECT job_id, pos, 'in' AS side, source_in AS t FROM v_cuts UNION ALL SELECT job_id, pos, 'out', source_out FROM v_cuts),
n AS (SELECT e.job_id, e.pos, e.side, e.t, min_by(b.t, (abs(b.t - e.t), b.t)) AS beat FROM e LEFT JOIN v_beats b ON b.clip_id = e.job_id GROUP BY ALL),
q AS (SELECT *, coalesce(abs(beat - t) <= 0.5 AND beat <> t, false) AS mv FROM n)
SELECT job_id, pos, max(CASE WHEN side = 'in' THEN CASE WHEN mv THEN beat ELSE t END END) AS q_in, max(CASE WHEN side = 'out' THEN CASE WHEN mv THEN beat ELSE t END END) AS q_out, sum(mv::INT)::BIGINT AS moved FROM q GROUP BY 1, 2""")
def mus06(spark: SparkSession, sf: str) -> DataFrame:
    return music.quantize(v.v_cuts(spark, sf), v.v_beats(spark, sf))


@query("mus07_first_at_or_after", "v_beats v_cand", """SELECT p.job_id AS clip_id, p.candidate_id, p.anchor AS t, (SELECT min(b.t) FROM v_beats b WHERE b.clip_id = p.job_id AND b.t >= p.anchor - 1e-9) AS grid_t FROM v_cand p""")
def mus07(spark: SparkSession, sf: str) -> DataFrame:
    return music.first_at_or_after(_points(spark, sf), v.v_beats(spark, sf).select("clip_id", "t"))


@query("mus08_pick_events", "v_beats", f""", RECURSIVE_MARK {BARS}, sp AS (SELECT clip_id, (clip_id % 4) * 10e0 AS lo, (clip_id % 4) * 10e0 + 40 + (clip_id % 7) * 60e0 AS hi FROM (SELECT DISTINCT clip_id FROM v_beats)),
d AS (SELECT clip_id, b.start AS t FROM bars b JOIN sp USING (clip_id) WHERE b.start BETWEEN lo AND hi), c AS (SELECT clip_id FROM d GROUP BY 1 HAVING count(*) >= 6),
pool AS (SELECT clip_id, t, 'downbeat' AS kind FROM d WHERE clip_id IN (SELECT clip_id FROM c) UNION ALL SELECT clip_id, b.t, 'beat' FROM v_beats b JOIN sp USING (clip_id) WHERE b.t BETWEEN lo AND hi AND clip_id NOT IN (SELECT clip_id FROM c)),
pick AS (SELECT clip_id, min(t) AS t, min(kind) AS kind, 1 AS k FROM pool GROUP BY 1 UNION ALL SELECT clip_id, t, kind, k FROM (SELECT p.clip_id, q.t, q.kind, p.k + 1 AS k, row_number() OVER (PARTITION BY p.clip_id ORDER BY q.t) AS r FROM pick p JOIN pool q ON q.clip_id = p.clip_id AND q.t - p.t >= 20 - 1e-9 WHERE p.k < 6) WHERE r = 1)
SELECT clip_id, t, kind FROM pick""".replace(", RECURSIVE_MARK", ","))
def mus08(spark: SparkSession, sf: str) -> DataFrame:
    beats = v.v_beats(spark, sf)
    lo = (F.col("clip_id") % 4) * F.lit(10.0)
    spans = beats.select("clip_id").distinct().select("clip_id", lo.alias("lo"), (lo + 40 + (F.col("clip_id") % 7) * F.lit(60.0)).alias("hi"))
    return music.pick_events(music.bars(beats).select("clip_id", F.col("start").alias("t")), beats.select("clip_id", "t"), spans, 20.0, 6)