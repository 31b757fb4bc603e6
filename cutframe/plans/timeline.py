"""TML rows and SRC-12."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import timeline as tl
from ..operators.proposal import propose_timeline
from ..sources import views as v
from . import query

TIMES = "tm AS (SELECT *, sum(source_out - source_in) OVER (PARTITION BY job_id ORDER BY pos) AS proof_out, sum(source_out - source_in) OVER (PARTITION BY job_id ORDER BY pos) - (source_out - source_in) AS proof_in FROM v_cuts)"
REEL = "reels AS (SELECT reel, idx, name, sum(duration_s) OVER w - duration_s AS v0, sum(duration_s) OVER w AS v1 FROM v_cards WINDOW w AS (PARTITION BY reel ORDER BY idx))"


def r(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Rounded once, at the output."""
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in names})


def timed(spark: SparkSession, sf: str) -> DataFrame:
    return tl.program_times(v.v_cuts(spark, sf))


@query("src12_virtual_reel", "v_cards", f", {REEL} SELECT reel, idx, name, v0 AS start_s, v1 AS end_s FROM reels")
def src12(spark: SparkSession, sf: str) -> DataFrame:
    return tl.virtual_reel(v.v_cards(spark, sf)).withColumnsRenamed({"start": "start_s", "end": "end_s"})


@query("tml01_program_times", "v_cuts", f", {TIMES} SELECT job_id, pos, round(proof_in, 6) + 0e0 AS proof_in, round(proof_out, 6) AS proof_out FROM tm")
def tml01(spark: SparkSession, sf: str) -> DataFrame:
    return r(timed(spark, sf).select("job_id", "pos", "proof_in", "proof_out"), "proof_in", "proof_out")


@query("tml02_resolve_segments", "v_cuts v_cards", f""", {REEL} SELECT job_id, pos, x.idx, x.name, round(greatest(source_in, v0) - v0, 6) + 0e0 AS file_in, round(least(source_out, v1) - v0, 6) AS file_out
FROM v_cuts c JOIN reels x ON x.reel = c.job_id AND greatest(source_in, v0) < least(source_out, v1)""")
def tml02(spark: SparkSession, sf: str) -> DataFrame:
    return r(tl.resolve_segments(v.v_cuts(spark, sf), tl.virtual_reel(v.v_cards(spark, sf))), "file_in", "file_out")


@query("tml02_unplaced", "v_cuts v_cards", f""", {REEL} SELECT job_id, pos, cut_id FROM v_cuts c WHERE NOT EXISTS (SELECT 1 FROM reels x WHERE x.reel = c.job_id AND greatest(source_in, v0) < least(source_out, v1))""")
def tml02u(spark: SparkSession, sf: str) -> DataFrame:
    cuts = v.v_cuts(spark, sf)
    return tl.unplaced(cuts, tl.resolve_segments(cuts, tl.virtual_reel(v.v_cards(spark, sf)))).select("job_id", "pos", "cut_id")


@query("tml03_frame_counts", "v_cuts", f", {TIMES} SELECT job_id, pos, (round_even(round(proof_out, 6) * (30000 / 1001e0), 0) - round_even(round(proof_in, 6) * (30000 / 1001e0), 0))::BIGINT AS frames FROM tm")
def tml03(spark: SparkSession, sf: str) -> DataFrame:
    return tl.frame_counts(r(timed(spark, sf), "proof_in", "proof_out")).select("job_id", "pos", "frames")


@query("tml04_chunk_segments", "v_cuts", f""", {TIMES}, f AS (SELECT job_id, pos, round_even(round(proof_in, 6) * 25, 0)::BIGINT AS f0, round_even(round(proof_out, 6) * 25, 0)::BIGINT AS f1 FROM tm),
x AS (SELECT job_id, pos, f1, unnest(range(f0, f1, 250)) AS frame FROM f WHERE f1 > f0)
SELECT job_id, pos, frame, least(250, f1 - frame)::BIGINT AS frames, (frame + least(250, f1 - frame) / 2e0) / 25 AS mid_s FROM x""")
def tml04(spark: SparkSession, sf: str) -> DataFrame:
    return tl.chunk_segments(r(timed(spark, sf), "proof_in", "proof_out"))


@query("tml05_truncate", "v_cuts", f""", {TIMES} SELECT job_id, pos, round(source_in, 6) AS source_in, round(source_in + least(proof_out, 120) - proof_in, 6) AS source_out, round(least(proof_out, 120), 6) AS proof_out FROM tm WHERE proof_in < 120""")
def tml05(spark: SparkSession, sf: str) -> DataFrame:
    return r(tl.truncate(timed(spark, sf), 120.0).select("job_id", "pos", "source_in", "source_out", "proof_out"), "source_in", "source_out", "proof_out")


def _spine(spark: SparkSession, sf: str) -> DataFrame:
    return v.v_cuts(spark, sf).groupBy("job_id").agg(F.min("source_in").alias("start"), F.max("source_out").alias("end"))


@query("tml06_density_sections", "v_cuts v_cand", """, sp AS (SELECT job_id, min(source_in) AS s0, max(source_out) AS s1 FROM v_cuts GROUP BY 1),
o AS (SELECT job_id, start, "end", score, max("end") OVER (PARTITION BY job_id ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM v_cand),
c AS (SELECT job_id, greatest(start, coalesce(before, '-infinity'::DOUBLE)) AS start, "end", score FROM o WHERE "end" > greatest(start, coalesce(before, '-infinity'::DOUBLE))),
e AS (SELECT job_id, greatest(start, s0) AS start, least("end", s1) AS "end", score, s0, s1 FROM c JOIN sp USING (job_id) WHERE least("end", s1) > greatest(start, s0)),
x AS (SELECT job_id, coalesce(lag("end") OVER (PARTITION BY job_id ORDER BY start, "end"), s0) AS a, start AS b, NULL::DOUBLE AS density FROM e
 UNION ALL SELECT job_id, max("end"), any_value(s1), NULL FROM e GROUP BY 1 UNION ALL SELECT job_id, s0, s1, NULL FROM sp WHERE job_id NOT IN (SELECT job_id FROM e) UNION ALL SELECT job_id, start, "end", score FROM e)
SELECT job_id, a AS start_s, b AS end_s, density FROM x WHERE b - a > 0.5""")
def tml06(spark: SparkSession, sf: str) -> DataFrame:
    o = v.v_cand(spark, sf).select("job_id", "start", "end", F.col("score").alias("density"))
    return tl.density_sections(_spine(spark, sf), o).withColumnsRenamed({"start": "start_s", "end": "end_s"})


def _beat(t: str, beats: str) -> str:
    """SQL for the nearest of a list of beats within half a second, else t."""
    return f"coalesce(list_min(list_transform(list_filter({beats}, lambda x: abs(x - {t}) <= 0.5), lambda x: {{'far': abs(x - {t}), 'at_s': x}})).at_s, {t})"


#: One step of the recursion enters a section, or places its next shot. The layers name what a step works out in turn.
PROPOSED = f""", sp AS (SELECT job_id, min(source_in) + 7 AS s0, max(source_out) - 7 AS s1, CASE WHEN job_id % 10 > 0 THEN max(source_out) ELSE 0 END AS reel, least(job_id % 4 / 10e0, 0.5) AS base FROM v_cuts GROUP BY 1 HAVING max(source_out) - min(source_in) - 14 > 1),
o AS (SELECT job_id, start, "end" + 60 AS "end", score, max("end" + 60) OVER (PARTITION BY job_id ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM v_cand WHERE event % 5 = 0),
c AS (SELECT job_id, greatest(start, coalesce(before, '-infinity'::DOUBLE)) AS start, "end", score FROM o WHERE "end" > greatest(start, coalesce(before, '-infinity'::DOUBLE))),
e AS (SELECT job_id, greatest(start, s0) AS start, least("end", s1) AS "end", score, s0, s1 FROM c JOIN sp USING (job_id) WHERE least("end", s1) > greatest(start, s0)),
x AS (SELECT job_id, coalesce(lag("end") OVER (PARTITION BY job_id ORDER BY start, "end"), s0) AS a, start AS b, NULL::DOUBLE AS density FROM e
 UNION ALL SELECT job_id, max("end"), any_value(s1), NULL FROM e GROUP BY 1 UNION ALL SELECT job_id, s0, s1, NULL FROM sp WHERE job_id NOT IN (SELECT job_id FROM e) UNION ALL SELECT job_id, start, "end", score FROM e),
jt AS (SELECT job_id, s0, s1, reel, CASE WHEN reel > 0 THEN (SELECT list_sort(list({{'u': a, 'v': b, 'share': coalesce(density, base)}})) FROM x WHERE x.job_id = sp.job_id AND b - a > 0.5) ELSE [] END AS secs,
 (SELECT list(t) FROM v_beats b WHERE b.clip_id = sp.job_id) AS beats, (SELECT list(t) FROM v_beats b WHERE b.clip_id = sp.job_id AND i % 2 = 0) AS b_beats, (SELECT list({{'a': source_in, 'b': source_out, 'v': pos % 10 / 10e0}}) FROM v_cuts q WHERE q.job_id = sp.job_id AND source_out > source_in) AS acts FROM sp),
wk AS (SELECT job_id, 0 AS s, 0::BIGINT AS k, 0::BIGINT AS n, 0e0 AS anchor, 0e0 AS whole, true AS room, s0 AS at_s, '-infinity'::DOUBLE AS shown, 0e0 AS used, []::STRUCT(a DOUBLE, b DOUBLE)[] AS taken, []::STRUCT(angle VARCHAR, a DOUBLE, b DOUBLE)[] AS cuts FROM jt
 UNION ALL SELECT job_id, CASE WHEN fresh THEN s + 1 ELSE s END, CASE WHEN fresh THEN 0 ELSE k + 1 END,
  CASE WHEN NOT fresh THEN n WHEN moved < sec.v - 0.5 THEN greatest(0, round_even((sec.v - moved) * sec.share / 8, 0))::BIGINT ELSE 0 END, CASE WHEN fresh THEN moved ELSE anchor END, CASE WHEN fresh THEN sec.v - moved ELSE whole END, fresh OR NOT brief,
  CASE WHEN fresh THEN moved WHEN placed THEN stop ELSE at_s END, CASE WHEN placed THEN stop ELSE shown END, CASE WHEN placed THEN ob ELSE used END, CASE WHEN placed THEN list_append(taken, {{'a': wa, 'b': wb}}) ELSE taken END,
  CASE WHEN fresh AND moved - at_s >= 0.5 THEN list_append(cuts, {{'angle': 'A', 'a': at_s, 'b': moved}}) WHEN placed AND start > at_s + 0.5 THEN list_append(list_append(cuts, {{'angle': 'A', 'a': at_s, 'b': start}}), {{'angle': 'B', 'a': oa, 'b': ob}}) WHEN placed THEN list_append(cuts, {{'angle': 'B', 'a': oa, 'b': ob}}) ELSE cuts END
 FROM (SELECT *, CASE WHEN b2 - a2 >= 0.5 THEN a2 ELSE wa END AS oa, CASE WHEN b2 - a2 >= 0.5 THEN b2 ELSE wb END AS ob
 FROM (SELECT *, CASE WHEN ba >= used - 1e-6 THEN ba ELSE wa END AS a2, CASE WHEN bb <= stop - 8 - 1e-6 THEN bb ELSE wb END AS b2
 FROM (SELECT *, {_beat("wa", "b_beats")} AS ba, {_beat("wb", "b_beats")} AS bb
 FROM (SELECT *, coalesce(best.a, place) AS wa, CASE WHEN best IS NOT NULL THEN best.a + span ELSE least(place + span, reel) END AS wb
 FROM (SELECT *, CASE WHEN placed THEN list_min(list_filter(list_transform(list_filter(list_transform(range(0, floor((hi - used + 1e-6) / 0.5)::BIGINT + 1), lambda j: used + j * 0.5),
   lambda a: a + span <= reel + 1e-6 AND len(list_filter(taken, lambda u: least(a + span, u.b) - greatest(a, u.a) > 0.01)) = 0),
   lambda a: {{'loss': -round(list_sum(list_transform(acts, lambda g: g.v * greatest(0, least(a + span, g.b) - greatest(a, g.a)))) / span - 0.25::DOUBLE * abs(a - place) / greatest(hi - used, 1), 9), 'a': a}}), lambda y: y.loss < 1)) END AS best
 FROM (SELECT *, span < 0.5 AS brief, NOT fresh AND span >= 0.5 AND hi - used >= 0.5 AS placed, least(greatest(start - span, used), hi) AS place
 FROM (SELECT *, least(start - 8, reel - span) AS hi FROM (SELECT *, stop - start AS span
 FROM (SELECT *, CASE WHEN e1 > start THEN e1 ELSE e0 END AS stop FROM (SELECT *, CASE WHEN b1 >= shown + 8 - 1e-6 THEN b1 ELSE b0 END AS start
 FROM (SELECT *, {_beat("b0", "beats")} AS b1, {_beat("e0", "beats")} AS e1
 FROM (SELECT *, CASE WHEN at_s < sec.u - 0.5 THEN sec.u ELSE at_s END AS moved, least(b0 + 8, sec.v) AS e0
 FROM (SELECT *, secs[CASE WHEN fresh THEN s + 1 ELSE s END] AS sec, greatest(CASE WHEN n > 0 THEN anchor + (k + 0.5::DOUBLE) * whole / n ELSE 0 END, shown + 8) AS b0
 FROM (SELECT w.*, NOT (k < n AND room) AS fresh, secs, beats, b_beats, acts, reel FROM wk w JOIN jt ON jt.job_id = w.job_id)))))))))))))) WHERE NOT (fresh AND s >= len(secs))),
dn AS (SELECT job_id, max_by({{'at_s': at_s, 'cuts': cuts}}, s * 100000 + k) AS z FROM wk GROUP BY 1),
fi AS (SELECT job_id, CASE WHEN s1 - z.at_s >= 0.5 THEN list_append(z.cuts, {{'angle': 'A', 'a': z.at_s, 'b': s1}}) WHEN len(z.cuts) = 0 THEN [{{'angle': 'A', 'a': s0, 'b': s1}}] ELSE z.cuts END AS cuts FROM dn JOIN jt USING (job_id))
SELECT job_id, i AS pos, cuts[i + 1].angle AS angle, round(cuts[i + 1].a, 3) AS source_in, round(cuts[i + 1].b, 3) AS source_out, printf('cut_%03d', i + 1) AS cut_id FROM fi, LATERAL (SELECT unnest(range(0, len(cuts))) AS i)"""


@query("tml07_propose_timeline", "v_cuts v_beats v_cand", PROPOSED)
def tml07(spark: SparkSession, sf: str) -> DataFrame:
    cuts, beats = v.v_cuts(spark, sf), v.v_beats(spark, sf).withColumnRenamed("clip_id", "job_id")
    ends = _spine(spark, sf).select("job_id", (F.col("start") + 7).alias("start"), (F.col("end") - 7).alias("end"), F.when(F.col("job_id") % 10 > 0, F.col("end")).alias("reel"), (F.col("job_id") % 4 / 10.0).alias("density"))
    parts = v.v_cand(spark, sf).filter("event % 5 = 0").select("job_id", "start", (F.col("end") + 60).alias("end"), F.col("score").alias("density"))
    action = cuts.select("job_id", F.col("source_in").alias("s0"), F.col("source_out").alias("s1"), (F.col("pos") % 10 / 10.0).alias("score"))
    return propose_timeline(ends, parts, beats, beats.filter("i % 2 = 0"), action)


@query("tml08_timeline_stats", "v_cuts", f""", {TIMES}, g AS (SELECT *, source_out - source_in AS d, CASE WHEN angle = 'B' THEN proof_in - max(CASE WHEN angle = 'B' THEN proof_out END) OVER (PARTITION BY job_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS gap FROM tm)
SELECT job_id, count(*) AS cuts, count(*) FILTER (WHERE angle = 'B') AS b_cuts, round(100 * coalesce(sum(d) FILTER (WHERE angle = 'B'), 0) / sum(d), 6) AS b_pct, round(min(d) FILTER (WHERE angle = 'B'), 6) AS b_min, round(max(d) FILTER (WHERE angle = 'B'), 6) AS b_max, round(avg(d) FILTER (WHERE angle = 'B'), 6) AS b_avg, round(min(gap) FILTER (WHERE gap > 1e-6), 6) AS min_recovery, round(sum(d), 6) AS runtime FROM g GROUP BY 1""")
def tml08(spark: SparkSession, sf: str) -> DataFrame:
    return r(tl.timeline_stats(v.v_cuts(spark, sf)), "b_pct", "b_min", "b_max", "b_avg", "min_recovery", "runtime")


@query("tml09_policy_violations", "v_cuts", f""", p AS (SELECT DISTINCT job_id, (job_id % 30 + 10)::DOUBLE AS lo, (job_id % 30 + 25)::DOUBLE AS hi FROM v_cuts),
s AS (SELECT job_id, 100 * coalesce(sum(source_out - source_in) FILTER (WHERE angle = 'B'), 0) / sum(source_out - source_in) AS b_pct FROM v_cuts GROUP BY 1),
w AS (SELECT *, source_out - source_in AS d, lag(angle) OVER (PARTITION BY job_id ORDER BY pos) = 'B' AS after_b, lead(angle) OVER (PARTITION BY job_id ORDER BY pos) IS NOT NULL AS more FROM v_cuts)
SELECT * FROM (SELECT job_id, NULL::BIGINT AS pos, CASE WHEN b_pct < lo THEN 'density_low' WHEN b_pct > hi THEN 'density_high' END AS rule FROM s JOIN p USING (job_id)
UNION ALL SELECT job_id, pos, unnest([CASE WHEN angle = 'B' AND d < 2 THEN 'shot_short' END, CASE WHEN angle = 'B' AND d > 20 THEN 'shot_long' END, CASE WHEN angle = 'B' AND confidence = 'low' THEN 'low_confidence' END, CASE WHEN angle <> 'B' AND after_b AND more AND d < 5 THEN 'short_recovery' END]) FROM w) WHERE rule IS NOT NULL""")
def tml09(spark: SparkSession, sf: str) -> DataFrame:
    cuts = v.v_cuts(spark, sf)
    policy = cuts.select("job_id").distinct().select("job_id", F.concat_ws("-", F.col("job_id") % 30 + 10, F.concat(F.col("job_id") % 30 + 25, F.lit("%"))).alias("density"), F.lit(2.0).alias("min_b"), F.lit(20.0).alias("max_b"), F.lit(5.0).alias("min_recovery"))
    return tl.policy_violations(cuts, policy)


RUNS = TIMES + """, fl AS (SELECT *, CASE WHEN lag(angle) OVER (PARTITION BY job_id ORDER BY pos) = angle THEN 0 ELSE 1 END AS new FROM tm),
isl AS (SELECT *, sum(new) OVER (PARTITION BY job_id ORDER BY pos) AS run FROM fl),
runs AS (SELECT job_id, run::BIGINT AS run, min(proof_in) AS a, max(proof_out) AS b, list(cut_id ORDER BY pos) AS ids FROM isl WHERE angle = 'A' GROUP BY 1, 2)"""


@query("tml10_angle_runs", "v_cuts", f', {RUNS} SELECT job_id, run, round(a, 6) + 0e0 AS start_s, round(b, 6) AS end_s, array_to_string(ids, \',\') AS ids, b - a > 20 AS "long" FROM runs')
def tml10(spark: SparkSession, sf: str) -> DataFrame:
    return r(tl.angle_runs(v.v_cuts(spark, sf)), "start", "end").withColumn("ids", F.array_join("ids", ",")).withColumnsRenamed({"start": "start_s", "end": "end_s"})


@query("tml11_offer_opportunities", "v_cuts v_cand", f""", {RUNS}, f AS (SELECT job_id, event AS event_id, min(anchor) - 4 AS ats, max(duration_s) AS face_s FROM v_cand GROUP BY 1, 2),
i AS (SELECT x.job_id, x.run, f.event_id, f.ats, f.face_s, row_number() OVER (PARTITION BY x.job_id, x.run ORDER BY face_s DESC, ats, event_id) AS o FROM runs x JOIN f ON f.job_id = x.job_id AND f.ats BETWEEN a + 2 AND b - 2 WHERE b - a > 20 AND b - 2 >= a + 2),
pick AS (SELECT job_id, run, o, ats, 1 AS k FROM i WHERE o = 1 UNION ALL SELECT job_id, run, o, ats, k FROM (SELECT i.job_id, i.run, i.o, i.ats, p.k + 1 AS k, row_number() OVER (PARTITION BY i.job_id, i.run ORDER BY i.o) AS z FROM pick p JOIN i ON i.job_id = p.job_id AND i.run = p.run AND i.o > p.o AND abs(i.ats - p.ats) >= 5 WHERE p.k < 4) WHERE z = 1)
SELECT job_id, run, i.event_id, i.ats AS at_s, i.face_s FROM pick JOIN i USING (job_id, run, o)""")
def tml11(spark: SparkSession, sf: str) -> DataFrame:
    faces = v.v_cand(spark, sf).groupBy("job_id", F.col("event").alias("event_id")).agg((F.min("anchor") - 4).alias("at"), F.max("duration_s").alias("face_s"))
    return tl.offer_opportunities(tl.angle_runs(v.v_cuts(spark, sf)), faces, edge=2.0, separation=5.0).withColumnRenamed("at", "at_s")


PROMO = "pr AS (SELECT job_id, pos AS promo, proof_in + (proof_out - proof_in) / 4 AS p_in, proof_in + (proof_out - proof_in) / 2 AS p_out, source_in + 100 AS b_in FROM tm WHERE angle = 'A' AND pos % 3 = 0 UNION ALL SELECT job_id, pos + 100000, proof_in + (proof_out - proof_in) * 0.625e0, proof_in + (proof_out - proof_in) * 0.75e0, source_in + 200 FROM tm WHERE angle = 'A' AND pos % 6 = 0)"


@query("tml13_apply_promotions", "v_cuts", f""", {TIMES}, {PROMO}, h AS (SELECT t.job_id, t.pos, t.proof_in, t.proof_out, t.source_in, p_in, p_out, b_in FROM tm t JOIN pr p ON p.job_id = t.job_id AND p_in >= proof_in AND p_out <= proof_out AND greatest(p_in, proof_in) < least(p_out, proof_out) WHERE angle = 'A'),
c AS (SELECT *, coalesce(lag(p_out) OVER (PARTITION BY job_id, pos ORDER BY p_in), proof_in) AS f, lead(p_in) OVER (PARTITION BY job_id, pos ORDER BY p_in) IS NULL AS last FROM h),
e AS (SELECT job_id, f AS a, p_in AS b, 'A' AS angle, f + (source_in - proof_in) AS s, 'split' AS origin FROM c UNION ALL SELECT job_id, p_out, proof_out, 'A', p_out + (source_in - proof_in), 'split' FROM c WHERE last
 UNION ALL SELECT job_id, p_in, p_out, 'B', b_in, 'promotion' FROM c UNION ALL SELECT job_id, proof_in, proof_out, angle, source_in, 'kept' FROM tm t WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.job_id = t.job_id AND h.pos = t.pos))
SELECT job_id, row_number() OVER (PARTITION BY job_id ORDER BY a) - 1 AS pos, angle, round(a, 6) + 0e0 AS proof_in, round(b, 6) AS proof_out, round(s, 6) AS source_in, origin FROM e WHERE b > a""")
def tml13(spark: SparkSession, sf: str) -> DataFrame:
    t = timed(spark, sf)
    at = lambda x: F.col("proof_in") + (F.col("proof_out") - F.col("proof_in")) * x
    a = t.filter("angle = 'A'")
    one = a.filter("pos % 3 = 0").select("job_id", F.col("pos").cast("bigint").alias("promo"), at(0.25).alias("p_in"), at(0.5).alias("p_out"), (F.col("source_in") + 100).alias("b_in"))
    two = a.filter("pos % 6 = 0").select("job_id", (F.col("pos") + 100000).cast("bigint").alias("promo"), at(0.625).alias("p_in"), at(0.75).alias("p_out"), (F.col("source_in") + 200).alias("b_in"))
    return r(tl.apply_promotions(t, one.unionByName(two)), "proof_in", "proof_out", "source_in").select("job_id", "pos", "angle", "proof_in", "proof_out", "source_in", "origin")


@query("tml14_program_rollup", "v_cuts", f""", {RUNS}, l AS (SELECT job_id, max(b - a) AS longest FROM runs GROUP BY 1)
SELECT job_id, round(sum(source_out - source_in), 6) AS total_s, round(coalesce(any_value(longest), 0), 6) AS longest_a, round(coalesce(sum(source_out - source_in) FILTER (WHERE angle = 'B'), 0), 6) AS b_s, round(100 * coalesce(sum(source_out - source_in) FILTER (WHERE angle = 'B'), 0) / sum(source_out - source_in), 6) AS b_pct FROM v_cuts LEFT JOIN l USING (job_id) GROUP BY 1""")
def tml14(spark: SparkSession, sf: str) -> DataFrame:
    return r(tl.program_rollup(v.v_cuts(spark, sf)), "total_s", "longest_a", "b_s", "b_pct")


@query("tml15_boundary_ownership", "v_cuts v_beats", f""", {TIMES}, tr AS (SELECT job_id, cut_id, round(proof_in, 6) AS proof_in, round(proof_out, 6) AS proof_out FROM tm), b AS (SELECT clip_id AS job_id, i AS bound_id, round(t + 0.01e0, 6) AS t FROM v_beats WHERE i % 5 = 0),
x AS (SELECT b.*, e.cut_id AS before, e.proof_out AS left_edge FROM b ASOF LEFT JOIN tr e ON e.job_id = b.job_id AND b.t >= e.proof_out),
y AS (SELECT x.*, s.cut_id AS c, s.proof_in AS s_in, s.proof_out AS s_out FROM x ASOF LEFT JOIN tr s ON s.job_id = x.job_id AND x.t >= s.proof_in),
z AS (SELECT y.*, n.cut_id AS after, n.proof_in AS n_in FROM y ASOF LEFT JOIN tr n ON n.job_id = y.job_id AND y.t <= n.proof_in)
SELECT job_id, bound_id, round(t, 6) AS t, CASE WHEN t < s_out THEN c END AS containing, before, after, coalesce(least(abs(t - left_edge), abs(t - s_in), abs(n_in - t)) <= 0.02, false) AS is_cut FROM z""")
def tml15(spark: SparkSession, sf: str) -> DataFrame:
    b = v.v_beats(spark, sf).filter("i % 5 = 0").select(F.col("clip_id").alias("job_id"), F.col("i").alias("bound_id"), F.round(F.col("t") + 0.01, 6).alias("t"))
    return r(tl.boundary_ownership(b, r(timed(spark, sf), "proof_in", "proof_out")), "t")


@query("tml16_headers_agree", "", """SELECT o_custkey AS job_id, count(*) AS n, count(DISTINCT o_orderstatus || '|' || o_orderpriority) AS headers, count(DISTINCT o_orderstatus || '|' || o_orderpriority) = 1 AS agree FROM orders GROUP BY 1""")
def tml16(spark: SparkSession, sf: str) -> DataFrame:
    return tl.headers_agree(v.table(spark, sf, "orders").withColumnRenamed("o_custkey", "job_id"), ["job_id"], ["o_orderstatus", "o_orderpriority"])


@query("tml17_chain_to_timeline", "v_cuts", """, i AS (SELECT job_id, source_in AS tl_in, source_in + (source_out - source_in) / 2 AS tl_out FROM v_cuts WHERE angle = 'B'), s AS (SELECT job_id, min(source_in) AS lo, max(source_out) AS hi FROM v_cuts GROUP BY 1),
x AS (SELECT i.*, lo, hi, coalesce(lag(tl_out) OVER w, lo) AS prev, lead(tl_in) OVER w IS NULL AS tail FROM i JOIN s USING (job_id) WINDOW w AS (PARTITION BY i.job_id ORDER BY tl_in)),
e AS (SELECT job_id, prev AS a, tl_in AS b, 'A' AS angle FROM x UNION ALL SELECT job_id, tl_out, hi, 'A' FROM x WHERE tail UNION ALL SELECT job_id, tl_in, tl_out, 'B' FROM x)
SELECT job_id, row_number() OVER (PARTITION BY job_id ORDER BY a) - 1 AS pos, a, b, angle FROM e WHERE b > a""")
def tml17(spark: SparkSession, sf: str) -> DataFrame:
    i = v.v_cuts(spark, sf).filter("angle = 'B'").select("job_id", F.col("source_in").alias("tl_in"), (F.col("source_in") + (F.col("source_out") - F.col("source_in")) / 2).alias("tl_out"))
    return tl.chain_to_timeline(i, _spine(spark, sf).withColumnsRenamed({"start": "lo", "end": "hi"}))


@query("tml18_context_proof", "v_cuts", """, p AS (SELECT * FROM v_cuts WHERE angle = 'B' AND pos % 2 = 0), e AS (SELECT job_id, pos, 0 AS part, 'A' AS angle, source_in - 8 AS a, source_in AS b FROM p UNION ALL SELECT job_id, pos, 1, 'B', source_in, source_out FROM p)
SELECT job_id, pos, part, angle, round(a, 6) AS source_in, round(b, 6) AS source_out, round(sum(b - a) OVER w, 6) AS proof_out, round(sum(b - a) OVER w - (b - a), 6) + 0e0 AS proof_in FROM e WINDOW w AS (PARTITION BY job_id ORDER BY pos, part)""")
def tml18(spark: SparkSession, sf: str) -> DataFrame:
    return r(tl.context_proof(v.v_cuts(spark, sf).filter("angle = 'B' and pos % 2 = 0"), 8.0), "source_in", "source_out", "proof_in", "proof_out")


def versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """A proposal and its approved version: some cuts dropped, some moved, some flipped."""
    p = v.v_cuts(spark, sf)
    a = p.filter("pos % 7 <> 3").select("job_id", "pos", F.when(F.col("pos") % 11 == 0, F.when(F.col("angle") == "A", "B").otherwise("A")).otherwise(F.col("angle")).alias("angle"), (F.col("source_in") + (F.col("pos") % 5) * 0.3).alias("source_in"), (F.col("source_out") + (F.col("pos") % 4) * 0.2).alias("source_out"))
    return p, a


VERSIONS = """ap AS (SELECT job_id, pos, CASE WHEN pos % 11 = 0 THEN CASE WHEN angle = 'A' THEN 'B' ELSE 'A' END ELSE angle END AS angle, source_in + (pos % 5) * 0.3::DOUBLE AS source_in, source_out + (pos % 4) * 0.2::DOUBLE AS source_out FROM v_cuts WHERE pos % 7 <> 3),
cp AS (SELECT p.job_id, p.pos AS p_pos, a.pos AS a_pos, abs(a.source_in - p.source_in) AS dist FROM v_cuts p JOIN ap a ON a.job_id = p.job_id AND a.source_in BETWEEN p.source_in - 1 AND p.source_in + 1),
jobs AS (SELECT DISTINCT job_id FROM cp),
st AS (SELECT job_id, row_number() OVER (PARTITION BY job_id ORDER BY p_pos, dist, a_pos) AS o, p_pos, a_pos, dist FROM cp),
wk AS (SELECT job_id, 0::BIGINT AS o, []::BIGINT[] AS ps, []::BIGINT[] AS qs FROM jobs
 UNION ALL SELECT w.job_id, s.o, CASE WHEN list_contains(ps, s.p_pos) OR list_contains(qs, s.a_pos) THEN ps ELSE list_append(ps, s.p_pos) END, CASE WHEN list_contains(ps, s.p_pos) OR list_contains(qs, s.a_pos) THEN qs ELSE list_append(qs, s.a_pos) END FROM wk w JOIN st s ON s.job_id = w.job_id AND s.o = w.o + 1),
fin AS (SELECT job_id, max_by(ps, o) AS ps, max_by(qs, o) AS qs FROM wk GROUP BY 1),
mt AS (SELECT job_id, unnest(ps) AS p_pos, unnest(qs) AS a_pos FROM fin)"""


@query("tml19_match_cuts", "v_cuts", f", {VERSIONS} SELECT job_id, p_pos, a_pos FROM mt")
def tml19(spark: SparkSession, sf: str) -> DataFrame:
    return tl.match_cuts(*versions(spark, sf)).select("job_id", "p_pos", "a_pos")


DELTAS = VERSIONS + """, dl AS (SELECT m.job_id, m.p_pos, m.a_pos, list_filter([CASE WHEN a.angle <> p.angle THEN 'angle_flipped' END, CASE WHEN a.source_in - p.source_in > 0.25 THEN 'entered_late' WHEN a.source_in - p.source_in < -0.25 THEN 'entered_early' END, CASE WHEN (a.source_out - a.source_in) - (p.source_out - p.source_in) > 0.25 THEN 'held_longer' WHEN (a.source_out - a.source_in) - (p.source_out - p.source_in) < -0.25 THEN 'shortened' END], lambda x: x IS NOT NULL) AS tags
 FROM mt m JOIN v_cuts p ON p.job_id = m.job_id AND p.pos = m.p_pos JOIN ap a ON a.job_id = m.job_id AND a.pos = m.a_pos),
deltas AS (SELECT job_id, p_pos, a_pos, unnest(CASE WHEN len(tags) = 0 THEN ['unchanged'] ELSE tags END) AS delta FROM dl
 UNION ALL SELECT job_id, pos, NULL, 'removed_' || angle FROM v_cuts p WHERE NOT EXISTS (SELECT 1 FROM mt WHERE mt.job_id = p.job_id AND mt.p_pos = p.pos)
 UNION ALL SELECT job_id, NULL, pos, 'added_' || angle FROM ap a WHERE NOT EXISTS (SELECT 1 FROM mt WHERE mt.job_id = a.job_id AND mt.a_pos = a.pos))"""


def _deltas(spark: SparkSession, sf: str) -> DataFrame:
    p, a = versions(spark, sf)
    return tl.classify_deltas(p, a, tl.match_cuts(p, a))


@query("tml20_classify_deltas", "v_cuts", f", {DELTAS} SELECT job_id, p_pos, a_pos, delta FROM deltas")
def tml20(spark: SparkSession, sf: str) -> DataFrame:
    return _deltas(spark, sf)


@query("tml21_disagreement_profile", "v_cuts", f", {DELTAS} SELECT delta, count(*) AS n, count(DISTINCT job_id) AS jobs, round(count(*) / (SELECT count(DISTINCT job_id) FROM deltas), 9) AS per_job FROM deltas GROUP BY 1")
def tml21(spark: SparkSession, sf: str) -> DataFrame:
    return r(tl.disagreement_profile(_deltas(spark, sf)), "per_job", digits=9)


@query("tml22_edl_ticks", "v_cuts", """, x AS (SELECT job_id, pos, CASE WHEN angle = 'A' THEN 30000 ELSE 25 END AS num, CASE WHEN angle = 'A' THEN 1001 ELSE 1 END AS den, source_in AS a, source_out AS b FROM v_cuts),
f AS (SELECT *, round_even(a * (num / den), 0)::BIGINT AS src, (round_even(b * (num / den), 0) - round_even(a * (num / den), 0))::BIGINT AS frames FROM x),
k AS (SELECT *, round_even(frames * den / num * 120000, 0)::BIGINT AS ticks FROM f WHERE frames > 0)
SELECT job_id, pos, src, frames, ticks, (sum(ticks) OVER (PARTITION BY job_id ORDER BY pos) - ticks)::BIGINT AS at, dense_rank() OVER (PARTITION BY job_id ORDER BY num, den) AS format_id FROM k""")
def tml22(spark: SparkSession, sf: str) -> DataFrame:
    a = F.col("angle") == "A"
    x = v.v_cuts(spark, sf).select("job_id", "pos", F.col("source_in").alias("a"), F.col("source_out").alias("b"), F.when(a, 30000).otherwise(25).cast("bigint").alias("fps_num"), F.when(a, 1001).otherwise(1).cast("bigint").alias("fps_den"))
    return tl.edl_ticks(x)
