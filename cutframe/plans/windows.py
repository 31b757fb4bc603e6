"""CND-02, 03, 10, 12, TML-12 and EVD-09."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.blocks import overlap
from ..operators import windows as wi
from ..operators.scores import score_candidates
from ..sources import views as v
from . import query

SEGS = "sg AS (SELECT job_id, source_in AS s0, source_out AS s1, (pos % 10) / 10e0 AS score FROM v_cuts WHERE pos % 3 <> 0)"


def segments(spark: SparkSession, sf: str) -> DataFrame:
    return v.v_cuts(spark, sf).filter("pos % 3 <> 0").select("job_id", F.col("source_in").alias("s0"), F.col("source_out").alias("s1"), (F.col("pos") % 10 / 10.0).alias("score"))


def _grid(first: str) -> str:
    """SQL for the windows of a slot x from `first` on: starts by 1, lengths 4 to 8 by 1."""
    starts = f"list_transform(range(0, greatest(0, floor(x.hi - 4 - {first} + 1e-9)::BIGINT + 1)), lambda i: {first} + i)"
    return f"flatten(list_transform({starts}, lambda a: list_transform(range(0, greatest(1, floor(least(8, x.hi - a) - 4 + 1e-9)::BIGINT + 1)), lambda j: {{'w0': a, 'w1': a + 4 + j}})))"


def _best(spans: str, state: str) -> str:
    """SQL for the least (loss, start, end) of windows of a slot x with segments x.sg."""
    shared = "greatest(0, least(y.w1, u.b) - greatest(y.w0, u.a))"
    mean = f"list_sum(list_transform(x.sg, lambda u: u.v * {shared})) / nullif(list_sum(list_transform(x.sg, lambda u: {shared})), 0)"
    return f"list_sort(list_transform({spans}, lambda y: {{'loss': -round(coalesce({mean}, -1), 6), 'w0': y.w0, 'w1': y.w1, 'state': '{state}'}}))[1]"


def _free(spans: str) -> str:
    return f"list_filter({spans}, lambda z: len(list_filter(w.ks, lambda k: z.w0 < k.w1 AND z.w1 > k.w0)) = 0)"


LONGEST = "list_transform(range(0, floor(x.hi - 4 - x.lo + 1e-9)::BIGINT + 1), lambda i: {'w0': x.lo + i, 'w1': least(x.lo + i + 8, x.hi)})"


@query("cnd02_best_windows", "v_cuts v_cand", f""", {SEGS}, sl AS (SELECT job_id, row_number() OVER (PARTITION BY job_id ORDER BY anchor) AS slot, floor(anchor) AS lo, floor(anchor) + CASE WHEN job_id % 3 = 0 THEN event % 13 ELSE 14 END AS hi FROM v_cand),
sx AS (SELECT sl.job_id, slot, lo, hi, row_number() OVER (PARTITION BY sl.job_id ORDER BY slot) AS o, coalesce(list({{'a': s0, 'b': s1, 'v': score}}) FILTER (WHERE s0 IS NOT NULL), []) AS sg FROM sl LEFT JOIN sg ON sg.job_id = sl.job_id AND greatest(lo, s0) < least(hi, s1) WHERE hi - lo >= 4 GROUP BY 1, 2, 3, 4),
wk AS (SELECT job_id, 0::BIGINT AS o, 0::BIGINT AS slot, []::STRUCT(w0 DOUBLE, w1 DOUBLE)[] AS ks, NULL::STRUCT(loss DOUBLE, w0 DOUBLE, w1 DOUBLE, state VARCHAR) AS p FROM (SELECT DISTINCT job_id FROM sx)
 UNION ALL SELECT job_id, o, slot, list_append(ks, {{'w0': p.w0, 'w1': p.w1}}), p FROM (SELECT x.job_id, x.o, x.slot, w.ks, coalesce({_best(_free(_grid("greatest(x.lo, coalesce(list_max(list_transform(w.ks, lambda k: k.w1)), x.lo))")), "ordered")}, {_best(_free(_grid("x.lo")), "unordered")}, {_best(LONGEST, "reused")}) AS p FROM wk w JOIN sx x ON x.job_id = w.job_id AND x.o = w.o + 1))
SELECT sl.job_id, sl.slot, p.w0 AS w0, p.w1 AS w1, CASE WHEN p.loss <= 0 THEN -p.loss END AS score, coalesce(p.state, 'none') AS state FROM sl LEFT JOIN wk ON wk.job_id = sl.job_id AND wk.slot = sl.slot""")
def cnd02(spark: SparkSession, sf: str) -> DataFrame:
    slot = F.row_number().over(Window.partitionBy("job_id").orderBy("anchor"))
    lo = F.floor("anchor").cast("double")
    long = F.when(F.col("job_id") % 3 == 0, F.col("event") % 13).otherwise(14)
    slots = v.v_cand(spark, sf).select("job_id", slot.alias("slot"), lo.alias("lo"), (lo + long).alias("hi"))
    return wi.best_windows(slots, segments(spark, sf), least=4.0, most=8.0)


@query("cnd03_centered_window", "v_cuts v_cand", f""", {SEGS}, sl AS (SELECT job_id, candidate_id AS slot, anchor AS lo, anchor + 10 AS hi, anchor + 4 AS center FROM v_cand), st AS (SELECT *, unnest(range(0, 21)) AS i FROM sl), w AS (SELECT *, lo + i * 0.5e0 AS w0, lo + i * 0.5e0 + 6 AS w1 FROM st),
a AS (SELECT w.job_id, w.slot, w.i, w.w0, w.w1, w.center, w.lo, w.hi, coalesce(sum(s.score * (least(w1, s1) - greatest(w0, s0))) / 6, 0) AS act FROM w LEFT JOIN sg s ON s.job_id = w.job_id AND greatest(w0, s0) < least(w1, s1) GROUP BY ALL),
b AS (SELECT *, round(act - 0.25::DOUBLE * abs(w0 - center) / greatest(hi - lo, 1), 6) AS value FROM a) SELECT job_id, slot, min_by({{'a': w0, 'b': w1}}, (-value, i)).a AS w0, min_by({{'a': w0, 'b': w1}}, (-value, i)).b AS w1, max(value) AS value FROM b GROUP BY 1, 2""")
def cnd03(spark: SparkSession, sf: str) -> DataFrame:
    slots = v.v_cand(spark, sf).select("job_id", F.col("candidate_id").alias("slot"), F.col("anchor").alias("lo"), (F.col("anchor") + 10).alias("hi"), (F.col("anchor") + 4).alias("center"))
    return wi.centered_window(slots, segments(spark, sf), duration=6.0)


PATH = "pa AS (SELECT job_id, event, min(anchor) AS t0, min(anchor) + 5 AS t1, min(timeline_start) AS s0, min(timeline_start) + 5 AS s1 FROM v_cand GROUP BY 1, 2), pg AS (SELECT *, t0 - lag(t1) OVER w AS gap, s0 >= lag(s1) OVER w - 1e-9 AS ord FROM pa WINDOW w AS (PARTITION BY job_id ORDER BY t0, event)), px AS (SELECT job_id, event, round(CASE WHEN gap IS NULL THEN 1 WHEN gap >= 12 - 1e-9 AND ord THEN 1 WHEN NOT ord THEN least(greatest(0, least(1, gap / 12)), 0.25) ELSE greatest(0, least(1, gap / 12)) END, 6) AS continuity, round(greatest(0, least(1, coalesce(gap, t0) / 60)), 6) AS novelty FROM pg)"


def _path(spark: SparkSession, sf: str) -> DataFrame:
    p = v.v_cand(spark, sf).groupBy("job_id", "event").agg(F.min("anchor").alias("t0"), F.min("timeline_start").alias("s0"))
    return wi.path_scores(p.select("job_id", "event", "t0", (F.col("t0") + 5).alias("t1"), "s0", (F.col("s0") + 5).alias("s1")), recovery=12.0, novelty_cap=60.0)


@query("cnd10_path_scores", "v_cand", f", {PATH} SELECT * FROM px")
def cnd10a(spark: SparkSession, sf: str) -> DataFrame:
    return _path(spark, sf)


def _looks(spark: SparkSession, sf: str, rest: int) -> DataFrame:
    """The events of one parity as visual samples of an angle."""
    s, k = v.v_samples(spark, sf).filter(F.col("event_id") % 2 == rest), F.col("k")
    return s.select(
        F.col("clip_id").alias("job_id"),
        "t",
        F.when(k % 13 != 0, k % 7 == 0).alias("flagged"),
        (k % 31 == 0).alias("frozen"),
        F.when(k % 11 != 0, F.col("sig")).alias("sharpness"),
        F.when(k % 10 != 0, k * 2.0).alias("brightness"),
        F.when(k % 9 != 0, F.array(k / 100.0, 1 - k / 100.0)).alias("hist"),
    )


LOOKS = """lk AS (SELECT event_id % 2 AS side, clip_id AS job_id, t, CASE WHEN k % 13 <> 0 THEN k % 7 = 0 END AS flagged, k % 31 = 0 AS frozen, CASE WHEN k % 11 <> 0 THEN sig END AS sharpness, CASE WHEN k % 10 <> 0 THEN k * 2e0 END AS brightness, CASE WHEN k % 9 <> 0 THEN [k / 100e0, 1 - k / 100e0] END AS hist FROM v_samples),
rl AS (SELECT side, job_id, quantile_cont(sharpness, 0.9) AS p90 FROM lk GROUP BY 1, 2)"""


@query("cnd10_score_candidates", "v_samples v_beats v_cand v_cuts", f""", {PATH}, {SEGS}, {LOOKS},
kf AS (SELECT clip_id AS job_id, avg(sig) AS sharpness, avg(k) AS brightness, quantile_cont(sig, 0.9) AS p90 FROM v_samples WHERE kind = 'error' AND clip_id % 3 = 0 GROUP BY 1),
cc AS (SELECT job_id, event, candidate_id, event % 4 <> 0 AS switch, anchor AS t0, anchor + duration_s * 3 AS t1, timeline_start AS s0, timeline_start + duration_s * 2 AS s1 FROM v_cand),
wn AS (SELECT job_id, candidate_id, 0 AS side, t0 AS w0, t1 AS w1 FROM cc UNION ALL SELECT job_id, candidate_id, 1, s0, s1 FROM cc),
sm AS (SELECT w.job_id, w.candidate_id, w.side, l.*, row_number() OVER (PARTITION BY w.job_id, w.candidate_id, w.side ORDER BY l.t) AS i FROM wn w JOIN (SELECT job_id AS j, side AS sd, * EXCLUDE (job_id, side) FROM lk) l ON l.j = w.job_id AND l.sd = w.side AND l.t BETWEEN w.w0 - 1e-6 AND w.w1 + 1e-6),
vs AS (SELECT job_id, candidate_id, side, count(*) AS n, count(*) FILTER (WHERE NOT flagged AND NOT frozen) / count(*) AS clean, bool_or(coalesce(flagged, false) OR frozen) AS bad, avg(sharpness) AS sharpness, avg(brightness) AS brightness FROM sm GROUP BY 1, 2, 3),
si AS (SELECT a.job_id, a.candidate_id, avg(least(a.hist[1], b.hist[1]) + least(a.hist[2], b.hist[2])) AS similarity FROM sm a JOIN sm b ON a.side = 0 AND b.side = 1 AND b.job_id = a.job_id AND b.candidate_id = a.candidate_id AND b.i = a.i AND a.hist IS NOT NULL AND b.hist IS NOT NULL GROUP BY 1, 2),
ac AS (SELECT c.job_id, c.candidate_id, sum(g.score * (least(c.s1, g.s1) - greatest(c.s0, g.s0))) / sum(least(c.s1, g.s1) - greatest(c.s0, g.s0)) AS mean FROM cc c JOIN sg g ON g.job_id = c.job_id AND least(c.s1, g.s1) > greatest(c.s0, g.s0) GROUP BY 1, 2),
mx AS (SELECT job_id, max(score) AS most FROM sg GROUP BY 1),
mu AS (SELECT c.job_id, c.candidate_id, greatest(0, max(0.75::DOUBLE * (1 - abs(b.t - t0) / 0.12::DOUBLE)), coalesce(max(0.90::DOUBLE * (1 - abs(b.t - t0) / 0.25::DOUBLE)) FILTER (WHERE i % 4 = 0), 0), coalesce(max(1 - abs(b.t - t0) / 0.50::DOUBLE) FILTER (WHERE i % 16 = 0), 0)) AS musical FROM cc c JOIN v_beats b ON b.clip_id = c.job_id GROUP BY 1, 2),
bf AS (SELECT job_id, event, lag(t1) OVER w AS left_at, lag(s1) OVER w AS left_source FROM pa WINDOW w AS (PARTITION BY job_id ORDER BY t0, event)),
al AS (SELECT c.*, v.n, v.clean, v.bad, v.sharpness, v.brightness, rl.p90, kf.sharpness AS ks, kf.brightness AS kb, kf.p90 AS kp, similarity, mean, most, musical, left_at, c.t0 - coalesce(left_at, 0) AS gap, c.s0 >= left_source - 1e-9 AS ord FROM cc c LEFT JOIN vs v ON v.job_id = c.job_id AND v.candidate_id = c.candidate_id AND v.side = c.switch::INT LEFT JOIN rl ON rl.job_id = c.job_id AND rl.side = c.switch::INT LEFT JOIN kf ON kf.job_id = c.job_id LEFT JOIN si ON si.job_id = c.job_id AND si.candidate_id = c.candidate_id LEFT JOIN ac ON ac.job_id = c.job_id AND ac.candidate_id = c.candidate_id LEFT JOIN mx ON mx.job_id = c.job_id LEFT JOIN mu ON mu.job_id = c.job_id AND mu.candidate_id = c.candidate_id LEFT JOIN bf ON bf.job_id = c.job_id AND bf.event = c.event)
SELECT job_id, event, candidate_id, round_even(CASE WHEN job_id % 2 = 0 THEN least(1, CASE WHEN job_id % 10 = 0 THEN 0 ELSE job_id % 12 / 2e0 END / 5) ELSE 1 END, 3) AS sync, round_even(coalesce(musical, 0), 3) AS musical,
round_even(CASE WHEN switch AND most > 0 AND mean IS NOT NULL THEN least(1, mean / most) ELSE 0 END, 3) AS action,
round_even(CASE WHEN ks IS NOT NULL THEN 0.5::DOUBLE * least(1, ks / kp) + 0.5::DOUBLE * (1 - least(1, abs(kb - 128) / 128)) WHEN sharpness IS NOT NULL THEN 0.5::DOUBLE * least(1, sharpness / p90) + 0.5::DOUBLE * coalesce(1 - least(1, abs(brightness - 128) / 128), 0) ELSE 0 END, 3) AS quality,
round_even(CASE WHEN switch THEN coalesce(1 - similarity, 0) ELSE 0 END, 3) AS info_gain,
round_even(CASE WHEN NOT switch OR left_at IS NULL OR gap >= 12 - 1e-9 AND ord THEN 1 WHEN ord THEN greatest(0, least(1, gap / 12)) ELSE least(greatest(0, least(1, gap / 12)), 0.25) END, 3) AS continuity,
round_even(CASE WHEN switch THEN greatest(0, least(1, gap / 60)) ELSE 0 END, 3) AS novelty, round_even(CASE WHEN n IS NULL THEN 0.5 WHEN bad THEN 0 ELSE clean END, 3) AS coverage FROM al""")
def cnd10(spark: SparkSession, sf: str) -> DataFrame:
    t1, s1 = F.col("anchor") + F.col("duration_s") * 3, F.col("timeline_start") + F.col("duration_s") * 2
    cands = v.v_cand(spark, sf).select("job_id", "event", "candidate_id", (F.col("event") % 4 != 0).alias("switch"), F.col("anchor").alias("t0"), t1.alias("t1"), F.col("timeline_start").alias("s0"), s1.alias("s1"))
    s, beats = v.v_samples(spark, sf), v.v_beats(spark, sf)
    kf = s.filter("kind = 'error' and clip_id % 3 = 0").groupBy(F.col("clip_id").alias("job_id")).agg(F.lit(True).alias("usable"), F.avg("sig").alias("sharpness"), F.avg("k").alias("brightness"), F.percentile("sig", 0.9).alias("p90"))
    sync = s.filter("clip_id % 2 = 0").select(F.col("clip_id").alias("job_id"), F.when(F.col("clip_id") % 10 != 0, F.col("clip_id") % 12 / 2.0).alias("confidence")).distinct()
    grids = {name: beats.filter(F.col("i") % every == 0).select("clip_id", "t") for name, every in (("beat", 1), ("down", 4), ("phrase", 16))}
    p = v.v_cand(spark, sf).groupBy("job_id", "event").agg(F.min("anchor").alias("t0"), F.min("timeline_start").alias("s0"))
    path = p.select("job_id", "event", "t0", (F.col("t0") + 5).alias("t1"), "s0", (F.col("s0") + 5).alias("s1"))
    return score_candidates(cands, path=path, segs=segments(spark, sf), a_samples=_looks(spark, sf, 0), b_samples=_looks(spark, sf, 1), grids=grids, keyframes=kf, sync=sync, recovery=12.0, novelty_cap=60.0)


ONSETS = """ru AS (SELECT clip_id AS job_id, event_id AS run_id, t AS onset, t + k / 10e0 AS "end", sig AS strength, sig AS luma_min, k / 100e0 AS frozen_frac FROM v_samples WHERE kind = 'signup'),
nb AS (SELECT u.job_id, u.run_id, min_by(b.t, (abs(b.t - u.onset), b.t)) AS at_s FROM ru u LEFT JOIN v_beats b ON b.clip_id = u.job_id GROUP BY 1, 2),
dc AS (SELECT u.*, at_s, CASE WHEN "end" - onset < 2 THEN 'too_short' WHEN coalesce(abs(at_s - onset) > 6, true) THEN 'no_beat' WHEN coalesce("end" > CASE WHEN u.job_id % 10 <> 0 THEN 650 END, true) THEN 'past_reel' WHEN luma_min < 5 THEN 'dark' WHEN frozen_frac > 0.9 THEN 'frozen' WHEN EXISTS (SELECT 1 FROM v_cand c WHERE c.job_id = u.job_id AND at_s BETWEEN c.start AND c."end") THEN 'represented' END AS reason FROM ru u JOIN nb USING (job_id, run_id)),
od AS (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY strength DESC, run_id) AS o FROM dc WHERE reason IS NULL),
wk AS (SELECT job_id, 0::BIGINT AS o, []::DOUBLE[] AS ts, NULL::BIGINT AS run_id, false AS kept FROM (SELECT DISTINCT job_id FROM od) UNION ALL SELECT w.job_id, d.o, CASE WHEN len(list_filter(ts, lambda x: abs(x - d.at_s) < 30)) = 0 THEN list_append(ts, d.at_s) ELSE ts END, d.run_id, len(list_filter(ts, lambda x: abs(x - d.at_s) < 30)) = 0 FROM wk w JOIN od d ON d.job_id = w.job_id AND d.o = w.o + 1)"""


@query("cnd12_propose_onsets", "v_samples v_beats v_cand", f", {ONSETS} SELECT d.job_id, d.run_id, CASE WHEN reason IS NOT NULL THEN reason WHEN w.kept THEN 'proposed' ELSE 'min_gap' END AS decision, CASE WHEN w.kept THEN d.at_s END AS at_s FROM dc d LEFT JOIN wk w ON w.job_id = d.job_id AND w.run_id = d.run_id")
def cnd12(spark: SparkSession, sf: str) -> DataFrame:
    s = v.v_samples(spark, sf).filter("kind = 'signup'")
    runs = s.select(F.col("clip_id").alias("job_id"), F.col("event_id").alias("run_id"), F.col("t").alias("onset"), (F.col("t") + F.col("k") / 10.0).alias("end"), F.col("sig").alias("strength"), F.col("sig").alias("luma_min"), (F.col("k") / 100.0).alias("frozen_frac"))
    beats = v.v_beats(spark, sf).select(F.col("clip_id").alias("job_id"), "t")
    taken = v.v_cand(spark, sf).select("job_id", F.col("start").alias("a"), F.col("end").alias("b"))
    reels = runs.select("job_id").distinct().filter("job_id % 10 <> 0").withColumn("length", F.lit(650.0))
    return wi.propose_onsets(runs, beats, taken, reels, min_len=2.0, snap=6.0, gap=30.0, darkest=5.0, frozen=0.9).withColumnRenamed("at", "at_s")


@query("tml12_validate_promotions", "v_cand v_beats", """, p AS (SELECT job_id, candidate_id, CASE WHEN n % 17 = 0 THEN 'MAYBE' ELSE 'PROMOTE' END AS decision, duration_s, anchor, n FROM (SELECT *, substr(candidate_id, 2)::INT AS n FROM v_cand) WHERE n % 2 = 0), k AS (SELECT *, anchor + duration_s AS stop FROM p WHERE n % 5 <> 0), g AS (SELECT * FROM k WHERE duration_s BETWEEN 5 - 1e-6 AND 12 + 1e-6)
SELECT job_id, candidate_id, 'decision' AS rule FROM p WHERE decision = 'MAYBE' UNION ALL SELECT job_id, candidate_id, 'not_offered' FROM p WHERE n % 5 = 0 UNION ALL SELECT job_id, candidate_id, 'duration' FROM k WHERE NOT duration_s BETWEEN 5 - 1e-6 AND 12 + 1e-6
UNION ALL SELECT job_id, NULL, 'ceiling' FROM g GROUP BY 1 HAVING count(*) > 4 UNION ALL SELECT job_id, candidate_id, 'recovery' FROM (SELECT *, anchor - lag(stop) OVER (PARTITION BY job_id ORDER BY anchor, candidate_id) AS gap FROM g) WHERE gap < 20 - 1e-6
UNION ALL SELECT job_id, candidate_id, 'straddles' FROM g WHERE EXISTS (SELECT 1 FROM v_beats b WHERE b.clip_id = g.job_id AND b.i % 6 = 0 AND b.t > g.anchor AND b.t < g.stop)""")
def tml12(spark: SparkSession, sf: str) -> DataFrame:
    c = v.v_cand(spark, sf).withColumn("n", v.cand_number())
    p = c.filter("n % 2 = 0").select("job_id", "candidate_id", F.when(F.col("n") % 17 == 0, "MAYBE").otherwise("PROMOTE").alias("decision"), "duration_s")
    bounds = v.v_beats(spark, sf).filter("i % 6 = 0").select(F.col("clip_id").alias("job_id"), F.col("t").alias("b"))
    return wi.validate_promotions(p, c.filter("n % 5 <> 0").select("job_id", "candidate_id", "anchor"), bounds, least=5.0, most=12.0, ceiling=4, recovery=20.0)


@query("evd09_verify_package", "v_cand v_samples", """, e AS (SELECT job_id, candidate_id AS event, start AS a, "end" AS b FROM v_cand), f AS (SELECT e.job_id, e.event, CASE WHEN s.k % 2 = 0 THEN 'A' ELSE 'B' END AS angle, round(s.t, 3) AS t, CASE WHEN s.k % 9 = 0 THEN round(s.t, 3) + 1 ELSE round(s.t, 3) END AS named FROM e JOIN v_samples s ON s.clip_id = e.job_id AND s.t BETWEEN a - 1 AND b),
g AS (SELECT e.job_id, e.event, e.a, e.b, count(*) FILTER (WHERE angle = 'A') AS na, count(*) FILTER (WHERE angle = 'B') AS nb, max(t) AS last, bool_or(t IS NOT NULL AND abs(named - t) > 1e-3) AS noff, bool_or(t < e.a - 1e-6 OR t > e.b + 1e-6) AS outs FROM e LEFT JOIN f ON f.job_id = e.job_id AND f.event = e.event GROUP BY 1, 2, 3, 4)
SELECT * FROM (SELECT job_id, event, unnest([CASE WHEN greatest(na, nb) < floor((b - a) * 0.2) - 1 THEN 'too_few' END, CASE WHEN coalesce(last < b - 5, true) THEN 'ends_early' END, CASE WHEN abs(na - nb) > 1 THEN 'uneven' END, CASE WHEN noff THEN 'timecode' END, CASE WHEN coalesce(outs, false) THEN 'outside' END]) AS rule FROM g) WHERE rule IS NOT NULL""")
def evd09(spark: SparkSession, sf: str) -> DataFrame:
    e = v.v_cand(spark, sf).select("job_id", F.col("candidate_id").alias("event"), F.col("start").alias("a"), F.col("end").alias("b"))
    s = v.v_samples(spark, sf).select(F.col("clip_id").alias("job_id"), "t", "k").withColumn("t2", F.col("t"))
    met = overlap(e.withColumn("a1", F.col("a") - 1), s, "job_id", ("a1", "b"), ("t", "t2"), 16.0, closed=True)
    t = F.round("t", 3)
    named = F.when(F.col("k") % 9 == 0, t + 1).otherwise(t)
    name = F.format_string("f_%d-%06.3f.jpg", F.floor(named / 60).cast("long"), F.round(named - 60 * F.floor(named / 60), 3))
    frames = met.select("job_id", "event", F.when(F.col("k") % 2 == 0, "A").otherwise("B").alias("angle"), t.alias("t"), name.alias("name"))
    return wi.verify_package(frames, e, fps=0.2)


