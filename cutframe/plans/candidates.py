"""CND rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import candidates as ca
from ..operators import music
from ..operators.signals import frame_histogram
from ..sources import views as v
from . import query
from .music import BARS
from .signals import HIST
from .timeline import r


def _windows(spark: SparkSession, sf: str) -> DataFrame:
    return v.v_cand(spark, sf).select("job_id", "candidate_id", F.col("start").alias("w0"), F.col("end").alias("w1"))


@query("cnd01_overlap_mean", "v_cand v_cuts", """, s AS (SELECT job_id, source_in AS s0, source_out AS s1, (pos % 10) / 10e0 AS score FROM v_cuts WHERE pos % 3 <> 0),
g AS (SELECT c.job_id, candidate_id, sum(s.score * (least(c."end", s1) - greatest(c.start, s0))) / sum(least(c."end", s1) - greatest(c.start, s0)) AS score FROM v_cand c JOIN s ON s.job_id = c.job_id AND greatest(c.start, s0) < least(c."end", s1) GROUP BY 1, 2)
SELECT c.job_id, c.candidate_id, round(g.score, 9) AS score FROM v_cand c LEFT JOIN g USING (job_id, candidate_id)""")
def cnd01(spark: SparkSession, sf: str) -> DataFrame:
    segs = v.v_cuts(spark, sf).filter("pos % 3 <> 0").select("job_id", F.col("source_in").alias("s0"), F.col("source_out").alias("s1"), (F.col("pos") % 10 / 10.0).alias("score"))
    return r(ca.overlap_mean(_windows(spark, sf), segs, ["candidate_id"]), "score", digits=9)


@query("cnd04_window_visual", "v_cand v_samples", """, g AS (SELECT c.job_id, candidate_id, count(*) AS n, count(*) FILTER (WHERE NOT (s.k % 7 = 0 OR s.k % 5 = 0)) / count(*) AS clean, bool_or(s.k % 7 = 0 OR s.k % 5 = 0) AS any_flagged, avg(s.sig) AS sharpness, avg(s.k) AS brightness FROM v_cand c JOIN v_samples s ON s.clip_id = c.job_id AND s.t BETWEEN c.start - 1e-6 AND c."end" + 1e-6 GROUP BY 1, 2)
SELECT c.job_id, c.candidate_id, coalesce(n, 0) AS n, round(clean, 9) AS clean, any_flagged, round(sharpness, 9) AS sharpness, round(brightness, 9) AS brightness FROM v_cand c LEFT JOIN g USING (job_id, candidate_id)""")
def cnd04(spark: SparkSession, sf: str) -> DataFrame:
    s = v.v_samples(spark, sf).select(F.col("clip_id").alias("job_id"), "t", (F.col("k") % 7 == 0).alias("flagged"), (F.col("k") % 5 == 0).alias("frozen"), F.col("sig").alias("sharpness"), F.col("k").alias("brightness"))
    return r(ca.window_visual(_windows(spark, sf), s, ["candidate_id"]), "clean", "sharpness", "brightness", digits=9)


KF = "kf AS (SELECT clip_id, CASE WHEN k % 6 = 0 THEN NULL WHEN k % 6 = 1 THEN 0 ELSE sig END AS sh, k::DOUBLE AS br FROM v_samples WHERE kind = 'error'), kq AS (SELECT clip_id, coalesce(bool_or(sh > 0), false) AS usable, count(*) AS n, count(*) FILTER (WHERE sh IS NULL) AS unmeasured, count(*) FILTER (WHERE sh = 0) AS zero, avg(sh) FILTER (WHERE sh > 0) AS sharpness, avg(br) FILTER (WHERE sh > 0) AS brightness, quantile_cont(sh, 0.9) FILTER (WHERE sh > 0) AS p90 FROM kf GROUP BY 1)"


def _keyframes(spark: SparkSession, sf: str) -> DataFrame:
    s = v.v_samples(spark, sf).filter("kind = 'error'")
    return ca.keyframe_quality(s.select("clip_id", F.when(F.col("k") % 6 == 0, None).when(F.col("k") % 6 == 1, 0.0).otherwise(F.col("sig")).alias("sharpness"), F.col("k").cast("double").alias("brightness")))


@query("cnd05_keyframe_quality", "v_samples", f", {KF} SELECT clip_id, usable, n, unmeasured, zero, round(sharpness, 9) AS sharpness, round(brightness, 9) AS brightness, round(p90, 9) AS p90 FROM kq")
def cnd05(spark: SparkSession, sf: str) -> DataFrame:
    return r(_keyframes(spark, sf), "sharpness", "brightness", "p90", digits=9)


@query("cnd06_quality_score", "v_samples v_cand", f""", {KF}, k2 AS (SELECT * FROM kq WHERE usable AND clip_id % 3 <> 0), s2 AS (SELECT clip_id, avg(sig) AS sharpness, avg(k) AS brightness, quantile_cont(sig, 0.9) AS p90 FROM v_samples WHERE clip_id % 5 <> 0 GROUP BY 1)
SELECT c.job_id AS clip_id, c.candidate_id, CASE WHEN k2.sharpness IS NOT NULL THEN 'keyframes' WHEN s2.sharpness IS NOT NULL THEN 'samples' ELSE 'none' END AS source,
round(CASE WHEN k2.sharpness IS NOT NULL THEN 0.5::DOUBLE * least(1, k2.sharpness / k2.p90) + 0.5::DOUBLE * (1 - least(1, abs(k2.brightness - 128) / 128)) WHEN s2.sharpness IS NOT NULL THEN 0.5::DOUBLE * least(1, s2.sharpness / s2.p90) + 0.5::DOUBLE * (1 - least(1, abs(s2.brightness - 128) / 128)) ELSE 0 END, 8) AS quality
FROM v_cand c LEFT JOIN k2 ON k2.clip_id = c.job_id LEFT JOIN s2 ON s2.clip_id = c.job_id""")
def cnd06(spark: SparkSession, sf: str) -> DataFrame:
    w = v.v_cand(spark, sf).select(F.col("job_id").alias("clip_id"), "candidate_id")
    s = v.v_samples(spark, sf).filter("clip_id % 5 <> 0").groupBy("clip_id").agg(F.avg("sig").alias("sharpness"), F.avg("k").alias("brightness"), F.percentile("sig", 0.9).alias("p90"))
    return r(ca.quality_score(w, _keyframes(spark, sf).filter("usable and clip_id % 3 <> 0"), s), "quality", digits=8)


@query("cnd07_paired_similarity", "v_frames", f""", {HIST}, a AS (SELECT clip_id, row_number() OVER (PARTITION BY clip_id ORDER BY frame_no) AS i, hist FROM hs WHERE frame_no % 3 = 0), b AS (SELECT clip_id, row_number() OVER (PARTITION BY clip_id ORDER BY frame_no) AS i, hist FROM hs WHERE frame_no % 3 = 1)
SELECT a.clip_id, count(*) AS n, round(avg(list_sum(list_transform(list_zip(a.hist, b.hist), lambda z: least(z[1], z[2])))), 8) AS similarity FROM a JOIN b USING (clip_id, i) GROUP BY 1""")
def cnd07(spark: SparkSession, sf: str) -> DataFrame:
    h = frame_histogram(v.v_frames(spark, sf)).select("clip_id", F.col("frame_no").alias("t"), "hist")
    return r(ca.paired_similarity(h.filter("t % 3 = 0"), h.filter("t % 3 = 1"), ["clip_id"]), "similarity", digits=8)


DUR = f"""{BARS}, en AS (SELECT job_id AS clip_id, candidate_id AS entry_id, start, 40e0 AS dmax FROM v_cand),
ev AS (SELECT e.clip_id, e.entry_id, e.start, s.t, s.k / 100e0 AS motion, row_number() OVER (PARTITION BY e.clip_id, e.entry_id ORDER BY s.t) AS i, count(*) OVER (PARTITION BY e.clip_id, e.entry_id) AS n FROM en e JOIN v_samples s ON s.clip_id = e.clip_id AND s.t BETWEEN e.start - 1e-6 AND e.start + e.dmax + 1e-6 WHERE s.k IS NOT NULL),
pk AS (SELECT clip_id, entry_id, min_by({{'i': i, 't': t, 'm': motion}}, (-motion, i)) AS p, any_value(n) AS n, any_value(start) AS start, max(t) FILTER (WHERE i = 2) - min(t) AS period FROM ev WHERE n >= 4 GROUP BY 1, 2),
st AS (SELECT p.clip_id, p.entry_id, min(e.i) AS stop FROM pk p JOIN ev e USING (clip_id, entry_id) WHERE e.i > p.p.i AND e.motion < 0.6::DOUBLE * p.p.m GROUP BY 1, 2),
rn AS (SELECT p.*, coalesce(stop - 1, n) AS hi FROM pk p LEFT JOIN st USING (clip_id, entry_id)),
re AS (SELECT r.clip_id, r.entry_id, r.start, r.n, r.p.t AS peak_t, e.t + r.period AS run_end, r.hi = r.n AS open_ended FROM rn r JOIN ev e ON e.clip_id = r.clip_id AND e.entry_id = r.entry_id AND e.i = r.hi),
lm AS (SELECT *, (SELECT min(t) FROM v_beats b WHERE b.clip_id = re.clip_id AND b.t >= re.peak_t - 1e-9) AS lg, (SELECT min(t) FROM v_beats b WHERE b.clip_id = re.clip_id AND b.t >= re.run_end - 1e-9) AS la, (SELECT min(start) FROM bars b WHERE b.clip_id = re.clip_id AND b.start >= re.run_end - 1e-9) AS lh FROM re),
cl AS (SELECT *, round(CASE WHEN lg - start < 2 THEN 2 ELSE least(lg - start, 30) END, 3) AS g0, round(CASE WHEN la - start < 2 THEN 2 ELSE least(la - start, 30) END, 3) AS a0, round(CASE WHEN coalesce(lh, la) - start < 2 THEN 2 ELSE least(coalesce(lh, la) - start, 30) END, 3) AS h0 FROM lm WHERE lg IS NOT NULL AND la IS NOT NULL),
du AS (SELECT clip_id, entry_id, n, peak_t, run_end, open_ended, g0 AS glance, greatest(g0, a0) AS action, greatest(g0, a0, h0) AS hold, lh IS NULL AS fallback FROM cl)"""


def _durations(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    beats = v.v_beats(spark, sf)
    entries = v.v_cand(spark, sf).select(F.col("job_id").alias("clip_id"), F.col("candidate_id").alias("entry_id"), "start", F.lit(40.0).alias("dmax"))
    s = v.v_samples(spark, sf).select("clip_id", "t", (F.col("k") / 100.0).alias("motion"))
    down = music.bars(beats).select("clip_id", F.col("start").alias("t"))
    return entries, ca.derive_durations(entries, s, beats.select("clip_id", "t"), down, least=2.0, most=30.0)


@query("cnd08_derive_durations", "v_cand v_samples v_beats", f", {DUR} SELECT * REPLACE (round(run_end, 6) AS run_end) FROM du")
def cnd08(spark: SparkSession, sf: str) -> DataFrame:
    return r(_durations(spark, sf)[1], "run_end")


FACES = DUR + """, fc AS (SELECT e.clip_id, e.entry_id, unnest([CASE WHEN glance IS NOT NULL AND start - 1.5e0 >= 0 THEN {'face': 'b_early', 'a': start - 1.5e0, 'b': start - 1.5e0 + (action + 1.5e0)} END, CASE WHEN glance IS NOT NULL THEN {'face': 'b_glance', 'a': start, 'b': start + glance} END, CASE WHEN glance IS NOT NULL THEN {'face': 'b_action', 'a': start, 'b': start + action} END, CASE WHEN glance IS NOT NULL THEN {'face': 'b_hold', 'a': start, 'b': start + hold} END, {'face': 'hold_a', 'a': NULL::DOUBLE, 'b': NULL::DOUBLE}]) AS f FROM en e LEFT JOIN du USING (clip_id, entry_id)),
faces AS (SELECT clip_id, entry_id, f.face AS face, f.a AS start_s, f.b AS end_s FROM fc WHERE f IS NOT NULL)"""


def _faces(spark: SparkSession, sf: str) -> DataFrame:
    entries, d = _durations(spark, sf)
    return ca.generate_candidates(entries.withColumn("early", F.lit(1.5)), d).withColumnsRenamed({"start": "start_s", "end": "end_s"})


@query("cnd09_generate_candidates", "v_cand v_samples v_beats", f", {FACES} SELECT * REPLACE (round(start_s, 6) AS start_s, round(end_s, 6) AS end_s) FROM faces")
def cnd09(spark: SparkSession, sf: str) -> DataFrame:
    return r(_faces(spark, sf), "start_s", "end_s")


def scores(spark: SparkSession, sf: str) -> DataFrame:
    """Eight scores of each candidate, spread by its number; some are missing."""
    c = v.v_cand(spark, sf).withColumn("n", v.cand_number())
    parts = {name: F.when((F.col("n") + i) % 13 != 0, (F.col("n") * (i + 3) % 97) / 97.0) for i, name in enumerate(ca.WEIGHTS)}
    return c.withColumns(parts).select("job_id", "event", "candidate_id", *ca.WEIGHTS)


@query("cnd11_recommend", "v_cand", f""", s AS (SELECT job_id, event, candidate_id, round_even({" + ".join(f"coalesce(CASE WHEN (substr(candidate_id, 2)::INT + {i}) % 13 <> 0 THEN round_even((substr(candidate_id, 2)::INT * {i + 3} % 97) / 97e0, 3) END, 0) * {w}::DOUBLE" for i, w in enumerate(ca.WEIGHTS.values()))}, 6) AS w FROM v_cand)
SELECT job_id, event, max_by(candidate_id, (w, candidate_id)) AS recommended, max(w) AS w, count(*) AS n FROM s GROUP BY 1, 2""")
def cnd11(spark: SparkSession, sf: str) -> DataFrame:
    return ca.recommend(scores(spark, sf))


@query("cnd13_face_drift", "v_cand v_samples v_beats", f""", {FACES}, em AS (SELECT clip_id, entry_id, CASE WHEN face = 'b_hold' AND clip_id % 7 = 0 THEN 'b_long' ELSE face END AS face FROM faces WHERE NOT (face = 'b_early' AND clip_id % 5 = 0))
SELECT *, 'predicted' AS side FROM (SELECT clip_id, entry_id, face FROM faces EXCEPT ALL SELECT * FROM em) UNION ALL SELECT *, 'emitted' FROM (SELECT * FROM em EXCEPT ALL SELECT clip_id, entry_id, face FROM faces)""")
def cnd13(spark: SparkSession, sf: str) -> DataFrame:
    f = _faces(spark, sf).select("clip_id", "entry_id", "face")
    emitted = f.filter(~((F.col("face") == "b_early") & (F.col("clip_id") % 5 == 0))).withColumn("face", F.when((F.col("face") == "b_hold") & (F.col("clip_id") % 7 == 0), "b_long").otherwise(F.col("face")))
    return ca.face_drift(f, emitted)


@query("cnd14_merge_events", "v_cand v_beats", """, e AS (SELECT job_id, anchor AS at_s, 'base' AS origin FROM v_cand UNION ALL SELECT clip_id, t, 'supplemental' FROM v_beats WHERE i % 4 = 0)
SELECT job_id, at_s, origin, printf('ev_%03d', row_number() OVER (PARTITION BY job_id ORDER BY at_s, origin)) AS event_id FROM e""")
def cnd14(spark: SparkSession, sf: str) -> DataFrame:
    extra = v.v_beats(spark, sf).filter("i % 4 = 0").select(F.col("clip_id").alias("job_id"), F.col("t").alias("at"))
    return ca.merge_events(v.v_cand(spark, sf).select("job_id", F.col("anchor").alias("at")), extra).withColumnRenamed("at", "at_s")


