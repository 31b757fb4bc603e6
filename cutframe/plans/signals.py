"""SIG rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import signals as sg
from ..sources import views as v
from . import query
from .timeline import r

HIST = "hs AS (SELECT clip_id, frame_no, list_transform(range(0, 16), lambda b: len(list_filter(px, lambda x: x // 16 = b)) / 64e0) AS hist, px FROM v_frames)"
LAP = """lp AS (SELECT clip_id, frame_no, v, coalesce(lag(v) OVER c, v) + coalesce(lead(v) OVER c, v) + coalesce(lag(v) OVER w, v) + coalesce(lead(v) OVER w, v) - 4 * v AS l FROM v_pixels WINDOW w AS (PARTITION BY clip_id, frame_no, y ORDER BY x), c AS (PARTITION BY clip_id, frame_no, x ORDER BY y)),
ql AS (SELECT clip_id, frame_no, avg(v) AS brightness, var_pop(l) AS sharpness FROM lp GROUP BY 1, 2)"""
MOTION = "mo AS (SELECT clip_id, frame_no, coalesce(sum(abs(v - p)) / 64e0 / 255, 0) AS motion FROM (SELECT clip_id, frame_no, v, lag(v) OVER (PARTITION BY clip_id, y, x ORDER BY frame_no) AS p FROM v_pixels) GROUP BY 1, 2)"


@query("sig01_frame_histogram", "v_frames", f", {HIST} SELECT clip_id, frame_no, i AS bin, hist[i + 1] AS share FROM hs, (SELECT unnest(range(0, 16)) AS i)")
def sig01(spark: SparkSession, sf: str) -> DataFrame:
    return sg.frame_histogram(v.v_frames(spark, sf)).select("clip_id", "frame_no", F.posexplode("hist").alias("bin", "share")).withColumn("bin", F.col("bin").cast("bigint"))


@query("sig02_frame_quality", "v_pixels", f", {LAP} SELECT clip_id, frame_no, brightness, round(sharpness, 6) AS sharpness FROM ql")
def sig02(spark: SparkSession, sf: str) -> DataFrame:
    return r(sg.frame_quality(v.v_frames(spark, sf)).select("clip_id", "frame_no", "brightness", "sharpness"), "sharpness")


@query("sig03_frame_motion", "v_pixels", f", {MOTION} SELECT clip_id, frame_no, round(motion, 9) AS motion FROM mo")
def sig03(spark: SparkSession, sf: str) -> DataFrame:
    return r(sg.frame_motion(v.v_frames(spark, sf)).select("clip_id", "frame_no", "motion"), "motion", digits=9)


@query("sig04_hist_novelty", "v_frames", f""", {HIST}, h2 AS (SELECT clip_id, frame_no, CASE WHEN frame_no % 5 <> 2 THEN hist END AS hist FROM hs),
p AS (SELECT *, last_value(hist IGNORE NULLS) OVER (PARTITION BY clip_id ORDER BY frame_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM h2)
SELECT clip_id, frame_no, CASE WHEN hist IS NOT NULL AND prev IS NOT NULL THEN round(1 - list_sum(list_transform(list_zip(hist, prev), lambda z: least(z[1], z[2]))), 9) + 0e0 END AS novelty FROM p""")
def sig04(spark: SparkSession, sf: str) -> DataFrame:
    h = sg.frame_histogram(v.v_frames(spark, sf)).withColumn("hist", F.when(F.col("frame_no") % 5 != 2, F.col("hist")))
    return r(sg.hist_novelty(h).select("clip_id", "frame_no", "novelty"), "novelty", digits=9)


OBS = "os AS (SELECT clip_id, t, sig AS brightness, sig * 7 % 90 AS sharpness, k / 1000e0 AS motion FROM v_samples), ob AS (SELECT *, greatest(0, least(1, sharpness / 40)) AS detail FROM os), oc AS (SELECT *, greatest(0, least(1, (24 - brightness) / 24)) * (1 - detail) AS black_sev, greatest(0, least(1, (brightness - 235) / 20)) * (1 - detail) AS white_sev FROM ob)"


def _obs(spark: SparkSession, sf: str) -> DataFrame:
    s = v.v_samples(spark, sf).select("clip_id", "t", F.col("sig").alias("brightness"), (F.col("sig") * 7 % 90).alias("sharpness"), (F.col("k") / 1000.0).alias("motion"))
    return sg.obstruction(s)


@query("sig05_obstruction", "v_samples", f", {OBS} SELECT clip_id, t, detail, black_sev, white_sev, greatest(black_sev, white_sev) AS obstruction FROM oc")
def sig05(spark: SparkSession, sf: str) -> DataFrame:
    return _obs(spark, sf).select("clip_id", "t", "detail", "black_sev", "white_sev", "obstruction")


FROZEN = "fz AS (SELECT clip_id, t, coalesce(motion < 0.06, false) AS still FROM fm), f2 AS (SELECT *, CASE WHEN lag(still) OVER (PARTITION BY clip_id ORDER BY t) = still THEN 0 ELSE 1 END AS new FROM fz), f3 AS (SELECT *, sum(new) OVER (PARTITION BY clip_id ORDER BY t) AS isl FROM f2), fr AS (SELECT clip_id, t, still AND count(*) OVER (PARTITION BY clip_id, isl) >= 3 AS frozen FROM f3)"


@query("sig06_frozen_flag", "v_samples", f", fm AS (SELECT clip_id, t, CASE WHEN kind <> 'error' THEN k / 1000e0 END AS motion FROM v_samples), {FROZEN} SELECT * FROM fr")
def sig06(spark: SparkSession, sf: str) -> DataFrame:
    s = v.v_samples(spark, sf).select("clip_id", "t", F.when(F.col("kind") != "error", F.col("k") / 1000.0).alias("motion"))
    return sg.frozen_flag(s, 0.06).select("clip_id", "t", "frozen")


def _spans(spark: SparkSession, sf: str) -> DataFrame:
    return v.v_cand(spark, sf).select(F.col("job_id").alias("clip_id"), F.col("start").alias("a"), F.col("end").alias("b"))


@query("sig07_mark_used", "v_samples v_cand", """SELECT clip_id, t, EXISTS (SELECT 1 FROM v_cand c WHERE c.job_id = s.clip_id AND s.t BETWEEN c.start AND c."end") AS used FROM v_samples s""")
def sig07(spark: SparkSession, sf: str) -> DataFrame:
    return sg.mark_used(v.v_samples(spark, sf).select("clip_id", "t"), _spans(spark, sf))


_STATS = ", ".join(f"round({f}, 9) AS {c}_{n}" for c in ("motion", "brightness", "sharpness") for n, f in (("mean", f"avg({c})"), ("p10", f"quantile_cont({c}, 0.1)"), ("p50", f"quantile_cont({c}, 0.5)"), ("p90", f"quantile_cont({c}, 0.9)"), ("max", f"max({c})")))


@query("sig08_signal_summary", "v_samples v_cand", f""", {OBS}, fm AS (SELECT clip_id, t, motion FROM os), {FROZEN}, us AS (SELECT clip_id, t, EXISTS (SELECT 1 FROM v_cand c WHERE c.job_id = s.clip_id AND s.t BETWEEN c.start AND c."end") AS used FROM v_samples s),
a AS (SELECT oc.*, greatest(black_sev, white_sev) AS obs, frozen, used FROM oc JOIN fr USING (clip_id, t) JOIN us USING (clip_id, t))
SELECT clip_id, count(*) AS n, {_STATS}, round(count(*) FILTER (WHERE obs >= 0.5) / count(*), 9) AS obstructed, round(count(*) FILTER (WHERE frozen) / count(*), 9) AS frozen_frac, round(count(*) FILTER (WHERE obs < 0.5 AND NOT frozen) / count(*), 9) AS clean_frac, round(count(*) FILTER (WHERE used) / count(*), 9) AS used_frac FROM a GROUP BY 1""")
def sig08(spark: SparkSession, sf: str) -> DataFrame:
    full = sg.mark_used(sg.frozen_flag(_obs(spark, sf), 0.06), _spans(spark, sf))
    out = sg.signal_summary(full)
    return r(out, *[c for c in out.columns if c not in ("clip_id", "n")], digits=9)


@query("sig09_beat_alignment", "v_samples v_beats", """, s AS (SELECT * FROM v_samples WHERE kind IN ('signup','purchase','error')), d AS (SELECT s.clip_id, s.t, (SELECT min(abs(b.t - s.t)) FROM v_beats b WHERE b.clip_id = s.clip_id) AS d FROM s),
g AS (SELECT clip_id, avg(d) AS m, quantile_cont(d, 0.9) AS p, count(*) FILTER (WHERE d <= 0.05) / count(d) AS al, min(t) AS lo, max(t) AS hi FROM d GROUP BY 1)
SELECT clip_id, round(m, 6) AS mean_dist, round(p, 6) AS p90_dist, round(al, 9) AS aligned, (SELECT count(*) FROM v_beats b WHERE b.clip_id = g.clip_id AND b.t BETWEEN lo AND hi) AS beats_in_span FROM g""")
def sig09(spark: SparkSession, sf: str) -> DataFrame:
    s = v.v_samples(spark, sf).filter("kind in ('signup','purchase','error')")
    return r(r(sg.beat_alignment(s, v.v_beats(spark, sf)), "mean_dist", "p90_dist"), "aligned", digits=9)


@query("sig10_global_gain", "v_pixels", "SELECT clip_id, round(quantile_cont(v, 0.995), 6) AS p995, round(60 / quantile_cont(v, 0.995), 9) AS gain FROM v_pixels GROUP BY 1")
def sig10(spark: SparkSession, sf: str) -> DataFrame:
    return r(r(sg.global_gain(v.v_frames(spark, sf)), "p995"), "gain", digits=9)


CELLS = """nx AS (SELECT clip_id, frame_no, y, x, v, lead(v) OVER (PARTITION BY clip_id, y, x ORDER BY frame_no) AS n FROM v_pixels),
cl AS (SELECT clip_id, frame_no, (y // 2) * 4 + x // 2 AS cell, avg(abs(n - v)) AS c, sum(v) AS sv FROM nx WHERE n IS NOT NULL GROUP BY 1, 2, 3),
fg AS (SELECT clip_id, frame_no, avg(c) AS gl, max(c) AS loc, min_by(cell, (-c, cell)) AS cell, sum(sv) / 64e0 AS luma FROM cl GROUP BY 1, 2),
fl AS (SELECT clip_id, 2.5 * quantile_cont(gl, 0.1) AS flr FROM fg GROUP BY 1),
ca AS (SELECT g.clip_id, g.frame_no, g.gl, g.loc, g.cell, sum(greatest(c.c - g.gl, 0)) AS activ, sum(greatest(c.c - f.flr, 0)) AS artic, g.luma FROM fg g JOIN cl c USING (clip_id, frame_no) JOIN fl f ON f.clip_id = g.clip_id GROUP BY ALL)"""


@query("sig11_cell_activity", "v_pixels", f", {CELLS} SELECT clip_id, frame_no, round(gl, 6) AS glob, round(loc, 6) AS loc, cell, round(activ, 6) AS activ, round(artic, 6) AS artic, luma, round(loc / greatest(gl, 1e-6), 6) AS conc FROM ca")
def sig11(spark: SparkSession, sf: str) -> DataFrame:
    return r(sg.cell_activity(v.v_frames(spark, sf)), "glob", "loc", "activ", "artic", "conc")


@query("sig12_smooth_same", "v_samples", "SELECT clip_id, t, round(sum(sig) OVER (PARTITION BY clip_id ORDER BY t ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) / 5, 6) AS sm FROM v_samples")
def sig12(spark: SparkSession, sf: str) -> DataFrame:
    return r(sg.smooth_same(v.v_samples(spark, sf), "sig", "t").select("clip_id", "t", "sm"), "sm")


RMS = "lastsec AS (SELECT clip_id, floor(max(t))::BIGINT AS l FROM v_samples GROUP BY 1), gr AS (SELECT clip_id, unnest(range(0, l + 1)) AS sec FROM lastsec), e AS (SELECT clip_id, floor(t)::BIGINT AS sec, sqrt(avg(sig * sig)) AS rms FROM v_samples GROUP BY 1, 2), rm AS (SELECT clip_id, sec, coalesce(rms, 0) AS rms FROM gr LEFT JOIN e USING (clip_id, sec))"


@query("sig13_rms_per_second", "v_samples", f", {RMS} SELECT clip_id, sec, round(rms, 6) AS rms FROM rm")
def sig13(spark: SparkSession, sf: str) -> DataFrame:
    return r(sg.rms_per_second(v.v_samples(spark, sf).withColumnRenamed("sig", "v")), "rms")


@query("sig14_action_profile", "v_samples", f""", {RMS}, p AS (SELECT clip_id, quantile_cont(rms, 0.95) AS p95, max(sec) + 1 AS dur FROM rm GROUP BY 1)
SELECT clip_id, (sec // 10) * 10 + 2.5e0 AS start_s, least((sec // 10 + 1) * 10, any_value(dur)) + 2.5e0 AS end_s, round(avg(greatest(0, least(1, CASE WHEN p95 > 1e-6 THEN rms / p95 ELSE rms END))), 6) AS score FROM rm JOIN p USING (clip_id) GROUP BY clip_id, sec // 10""")
def sig14(spark: SparkSession, sf: str) -> DataFrame:
    return r(sg.action_profile(sg.rms_per_second(v.v_samples(spark, sf).withColumnRenamed("sig", "v")), 10, 2.5), "score")


KEY = "kq AS (SELECT clip_id, t, round(0.5::DOUBLE * least(1, sig * 4 / 400) + 0.25::DOUBLE * (1 - least(1, abs(sig - 118) / 118)) + 0.25::DOUBLE * coalesce(least(1, CASE WHEN kind <> 'signup' THEN k END / 12e0), 0.5), 9) AS score FROM v_samples)"


@query("sig15_pick_keyframes", "v_samples", f""", {KEY}, o AS (SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY score DESC, t) AS o FROM kq),
w AS (SELECT clip_id, 0::BIGINT AS o, []::DOUBLE[] AS ts FROM (SELECT DISTINCT clip_id FROM o) UNION ALL SELECT w.clip_id, o.o, CASE WHEN len(ts) < 5 AND len(list_filter(ts, lambda x: abs(x - o.t) < 30)) = 0 THEN list_append(ts, o.t) ELSE ts END FROM w JOIN o ON o.clip_id = w.clip_id AND o.o = w.o + 1),
f AS (SELECT clip_id, unnest(max_by(ts, o)) AS t FROM w GROUP BY 1) SELECT f.clip_id, f.t, kq.score FROM f JOIN kq USING (clip_id, t)""")
def sig15(spark: SparkSession, sf: str) -> DataFrame:
    s = v.v_samples(spark, sf).select("clip_id", "t", (F.col("sig") * 4).alias("sharpness"), F.col("sig").alias("brightness"), F.when(F.col("kind") != "signup", F.col("k")).alias("motion"))
    return sg.pick_keyframes(r(sg.keyframe_score(s), "score", digits=9), 5, 30.0)


@query("sig16_sample_times", "v_cuts", "SELECT job_id, pos, i, round(source_in + (source_out - source_in) * (i + 0.5e0) / 4, 6) AS t FROM v_cuts, (SELECT unnest([0, 1, 2, 3]) AS i)")
def sig16(spark: SparkSession, sf: str) -> DataFrame:
    return r(sg.sample_times(v.v_cuts(spark, sf).select("job_id", "pos", F.col("source_in").alias("a"), F.col("source_out").alias("b")), 4), "t")


@query("sig16_sample_every", "v_cuts", "SELECT job_id, pos, i::INTEGER AS i, round(source_in + i * 3e0, 6) AS t FROM (SELECT *, unnest(range(0, least(floor((source_out - source_in) / 3)::INTEGER, 5) + 1)) AS i FROM v_cuts)")
def sig16b(spark: SparkSession, sf: str) -> DataFrame:
    return r(sg.sample_every(v.v_cuts(spark, sf).select("job_id", "pos", F.col("source_in").alias("a"), F.col("source_out").alias("b")), 3.0, 6), "t")


@query("sig17_kick_phase", "v_samples v_beats", """, e AS (SELECT b.clip_id, b.i, coalesce(sqrt(avg(s.sig * s.sig)), 0) AS e FROM v_beats b LEFT JOIN v_samples s ON s.clip_id = b.clip_id AND s.t >= b.t AND s.t < b.t + 5 GROUP BY 1, 2),
p AS (SELECT clip_id, (i % 4)::BIGINT AS phase, sum(e) AS s, count(*) AS n, round(sum(e) / count(*), 9) AS m FROM e GROUP BY 1, 2),
g AS (SELECT clip_id, min_by(phase, (-m, phase)) AS phase, round(coalesce(max(m) / nullif(sum(s) / sum(n), 0), 0), 3) AS lift FROM p GROUP BY 1) SELECT clip_id, phase, lift, lift >= 1.05 AS detected FROM g""")
def sig17(spark: SparkSession, sf: str) -> DataFrame:
    audio = v.v_samples(spark, sf).select("clip_id", "t", F.col("sig").alias("v"))
    return sg.kick_phase(audio, v.v_beats(spark, sf), window=5.0).withColumn("phase", F.col("phase").cast("bigint"))


RGB = """rx AS (SELECT *, (r * 299 + g * 587 + b * 114) // 1000 AS y, greatest(r, g, b) - least(r, g, b) AS sat, 0.2126::DOUBLE * r + 0.7152::DOUBLE * g + 0.0722::DOUBLE * b AS l FROM v_rgb),
hy AS (SELECT clip_id, frame_no, y, sum(count(*)) OVER (PARTITION BY clip_id, frame_no ORDER BY y) AS cum, sum(count(*)) OVER (PARTITION BY clip_id, frame_no) AS n FROM rx GROUP BY 1, 2, 3),
qy AS (SELECT clip_id, frame_no, min(y) FILTER (WHERE cum >= n * 0.5) AS y50, min(y) FILTER (WHERE cum >= n * 0.95) AS y95 FROM hy GROUP BY 1, 2),
rs AS (SELECT clip_id, frame_no, avg(l) AS luma709, avg(y) AS luma601, avg(sat) AS chroma, avg(r) AS r, avg(g) AS g, avg(b) AS b, 100 * count(*) FILTER (WHERE y >= 235) / count(*) AS clipped_pct, 100 * count(*) FILTER (WHERE y < 16) / count(*) AS black_pct FROM rx GROUP BY 1, 2)"""


@query("sig18_rgb_stats", "v_rgb", f", {RGB} SELECT clip_id, frame_no, round(luma709, 6) AS luma709, round(luma601, 6) AS luma601, round(chroma, 6) AS chroma, round(r, 6) AS r, round(g, 6) AS g, round(b, 6) AS b, round(clipped_pct, 6) AS clipped_pct, round(black_pct, 6) AS black_pct, y50::INTEGER AS y50, y95::INTEGER AS y95 FROM rs JOIN qy USING (clip_id, frame_no)")
def sig18(spark: SparkSession, sf: str) -> DataFrame:
    return r(sg.rgb_stats(v.v_rgb(spark, sf)), "luma709", "luma601", "chroma", "r", "g", "b", "clipped_pct", "black_pct")


@query("sig19_frame_corr", "v_pixels", """, n AS (SELECT clip_id, frame_no, v, lead(v) OVER (PARTITION BY clip_id, y, x ORDER BY frame_no) AS w FROM v_pixels)
SELECT clip_id, frame_no, round(corr(v, w), 6) + 0e0 AS corr FROM n WHERE w IS NOT NULL GROUP BY 1, 2""")
def sig19(spark: SparkSession, sf: str) -> DataFrame:
    f = v.v_frames(spark, sf).withColumn("b", F.lead("px").over(sg.by_clip())).filter("b is not null")
    return r(sg.frame_corr(f.withColumnRenamed("px", "a")).select("clip_id", "frame_no", "corr"), "corr")
