"""QC rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import qc
from ..operators import signals as sg
from ..sources import views as v
from . import query
from .align import ENV, envelopes
from .signals import MOTION
from .timeline import TIMES, r, timed

DIFF = MOTION + ", df AS (SELECT clip_id, frame_no, round(motion, 9) AS d FROM mo)"


def diffs(spark: SparkSession, sf: str) -> DataFrame:
    return r(sg.frame_motion(v.v_frames(spark, sf)).select("clip_id", "frame_no", F.col("motion").alias("d")), "d", digits=9)


BURST = ", CASE WHEN frame_no - lag(frame_no) OVER (PARTITION BY clip_id ORDER BY frame_no) <= 2 THEN 0 ELSE 1 END AS new FROM {src}), b2 AS (SELECT *, sum(new) OVER (PARTITION BY clip_id ORDER BY frame_no) AS burst FROM b1) SELECT clip_id, min_by(frame_no, (-d, frame_no)) AS frame_no, max(d) AS d FROM b2 GROUP BY clip_id, burst"


@query("qc01_detect_cuts", "v_pixels", f", {DIFF}, md AS (SELECT clip_id, median(d) AS med FROM df GROUP BY 1), th AS (SELECT clip_id, any_value(med) + greatest(2 * median(abs(d - med)), 0.01::DOUBLE) AS thr FROM df JOIN md USING (clip_id) GROUP BY 1), hit AS (SELECT df.* FROM df JOIN th USING (clip_id) WHERE d > thr), b1 AS (SELECT *" + BURST.format(src="hit"))
def qc01(spark: SparkSession, sf: str) -> DataFrame:
    return qc.detect_cuts(diffs(spark, sf), mads=2.0)


@query("qc01_detect_fixed", "v_pixels", f", {DIFF}, b1 AS (SELECT *" + BURST.format(src="df WHERE d > 0.14"))
def qc01b(spark: SparkSession, sf: str) -> DataFrame:
    return qc.detect_cuts(diffs(spark, sf), fixed=0.14)


@query("qc02_classify_spikes", "v_samples", "SELECT clip_id, event_id AS frame_no, CASE WHEN coalesce(c >= 0.5, false) OR coalesce(ab >= 0.5 AND aa >= 0.5, false) OR coalesce(bb >= 0.5 AND ba >= 0.5, false) THEN 'motion' ELSE 'cut' END AS kind FROM (SELECT clip_id, event_id, CASE WHEN k % 6 <> 0 THEN k / 150e0 END AS c, sig / 60 AS ab, (sig + k) / 120 AS aa, CASE WHEN kind <> 'view' THEN sig / 90 END AS bb, k / 120e0 AS ba FROM v_samples)")
def qc02(spark: SparkSession, sf: str) -> DataFrame:
    s, k = v.v_samples(spark, sf), F.col("k")
    rows = s.select("clip_id", F.col("event_id").alias("frame_no"), F.when(k % 6 != 0, k / 150.0).alias("corr"), (F.col("sig") / 60).alias("a_before"), ((F.col("sig") + k) / 120).alias("a_after"), F.when(F.col("kind") != "view", F.col("sig") / 90).alias("b_before"), (k / 120.0).alias("b_after"))
    return qc.classify_spikes(rows).select("clip_id", "frame_no", "kind")


ATTR = """dt AS (SELECT clip_id AS job_id, t + (k % 7) * 0.1::DOUBLE AS t FROM v_samples WHERE kind = 'click'), pl AS (SELECT clip_id AS job_id, t AS at_s, 'cut_' || event_id AS cut_id FROM v_samples WHERE kind IN ('click', 'view') AND k % 3 <> 0)"""


def detections(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    s = v.v_samples(spark, sf)
    d = s.filter("kind = 'click'").select(F.col("clip_id").alias("job_id"), (F.col("t") + (F.col("k") % 7) * 0.1).alias("t"))
    p = s.filter("kind in ('click', 'view') and k % 3 <> 0").select(F.col("clip_id").alias("job_id"), F.col("t").alias("at"), F.concat(F.lit("cut_"), F.col("event_id").cast("string")).alias("cut_id"))
    return d, p


@query("qc03_attribute_cuts", "v_samples", f""", {ATTR}, n AS (SELECT d.job_id, d.t, min_by({{'a': p.at_s, 'c': p.cut_id}}, (abs(p.at_s - d.t), p.at_s)) AS x FROM dt d LEFT JOIN pl p ON p.job_id = d.job_id GROUP BY 1, 2),
f AS (SELECT job_id, t, CASE WHEN abs(t - x.a) <= 0.3 THEN x.c END AS cut_id, CASE WHEN abs(t - x.a) <= 0.3 THEN 'planned' ELSE 'unplanned' END AS state, round(CASE WHEN abs(t - x.a) <= 0.3 THEN abs(t - x.a) END, 6) AS error FROM n)
SELECT job_id, round(t, 6) AS t, cut_id, state, error FROM f UNION ALL SELECT job_id, round(at_s, 6), cut_id, 'missing', NULL FROM pl WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.job_id = pl.job_id AND f.cut_id = pl.cut_id)""")
def qc03(spark: SparkSession, sf: str) -> DataFrame:
    return r(qc.attribute_cuts(*detections(spark, sf)), "t", "error")


@query("qc04_segment_angle", "v_samples", "SELECT clip_id, event_id, CASE WHEN ok IS NULL THEN 'unavailable' WHEN ok THEN 'ok' ELSE 'wrong_angle' END AS state FROM (SELECT clip_id, event_id, CASE WHEN angle = 'A' THEN a >= 0.5 AND (b IS NULL OR a >= b) WHEN b IS NULL THEN CASE WHEN a IS NOT NULL THEN a < 0.5 END ELSE b >= 0.5 AND (a IS NULL OR b >= a) END AS ok FROM (SELECT clip_id, event_id, CASE WHEN kind IN ('view', 'click') THEN 'A' ELSE 'B' END AS angle, CASE WHEN k % 9 <> 0 THEN k / 100e0 END AS a, CASE WHEN k % 4 <> 0 THEN sig / 100 END AS b FROM v_samples))")
def qc04(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("k")
    s = v.v_samples(spark, sf).select("clip_id", "event_id", F.when(F.col("kind").isin("view", "click"), "A").otherwise("B").alias("angle"), F.when(k % 9 != 0, k / 100.0).alias("corr_a"), F.when(k % 4 != 0, F.col("sig") / 100).alias("corr_b"))
    return qc.segment_angle(s).select("clip_id", "event_id", "state")


@query("qc05_insert_lengths", "v_cuts", f", {TIMES} SELECT job_id, pos, round(abs((proof_out - proof_in) - (source_out + CASE WHEN pos % 8 = 1 THEN 0.2 ELSE 0 END - source_in)), 6) AS diff FROM tm WHERE angle = 'B' AND abs((proof_out - proof_in) - (source_out + CASE WHEN pos % 8 = 1 THEN 0.2 ELSE 0 END - source_in)) >= 0.05")
def qc05(spark: SparkSession, sf: str) -> DataFrame:
    t = timed(spark, sf).withColumn("source_out", F.col("source_out") + F.when(F.col("pos") % 8 == 1, 0.2).otherwise(0.0))
    return r(qc.insert_lengths(t).select("job_id", "pos", "diff"), "diff")


@query("qc06_boundary_check", "v_samples v_beats", f""", {ATTR}, bd AS (SELECT clip_id AS job_id, i AS bound_id, t AS b FROM v_beats WHERE i % 3 = 0), m AS (SELECT b.job_id, b.bound_id, d.t FROM bd b JOIN dt d ON d.job_id = b.job_id AND d.t BETWEEN b - 1 AND b + 1),
o AS (SELECT m.job_id, m.bound_id, m.t, (SELECT min(abs(p.at_s - m.t)) FROM pl p WHERE p.job_id = m.job_id) AS e FROM m), g AS (SELECT job_id, bound_id, count(*) AS changes FROM o WHERE e IS NULL OR e > 0.3 GROUP BY 1, 2)
SELECT b.job_id, b.bound_id, coalesce(changes, 0) AS changes, coalesce(changes, 0) > 0 AS visible FROM bd b LEFT JOIN g USING (job_id, bound_id)""")
def qc06(spark: SparkSession, sf: str) -> DataFrame:
    b = v.v_beats(spark, sf).filter("i % 3 = 0").select(F.col("clip_id").alias("job_id"), F.col("i").alias("bound_id"), F.col("t").alias("b"))
    return qc.boundary_check(b, *detections(spark, sf))


@query("qc07_audio_lag", "v_samples", f", {ENV}, c AS (SELECT a.pair, lag, round(corr(a.x, b.x), 6) AS c, count(*) AS k FROM ra a, (SELECT unnest(range(-10, 11)) AS lag) JOIN rb b ON b.pair = a.pair AND b.n = a.n + lag GROUP BY 1, 2 HAVING count(*) >= 10) SELECT pair, min_by(lag, (-c, abs(lag), lag))::INTEGER AS lag, max(c) AS corr FROM c WHERE c IS NOT NULL GROUP BY 1")
def qc07(spark: SparkSession, sf: str) -> DataFrame:
    return qc.audio_lag(*envelopes(spark, sf), 10, least=10)


@query("qc08_temporal_steps", "v_pixels", """, s AS (SELECT clip_id, frame_no, avg(v) AS luma, 100 * count(*) FILTER (WHERE v >= 235) / count(*) AS cl, 100 * count(*) FILTER (WHERE v < 16) / count(*) AS bl FROM v_pixels GROUP BY 1, 2), n AS (SELECT *, lead(luma) OVER w AS l2, lead(cl) OVER w AS c2, lead(bl) OVER w AS b2 FROM s WINDOW w AS (PARTITION BY clip_id ORDER BY frame_no))
SELECT clip_id, frame_no, round(abs(l2 - luma), 6) AS step, round(c2 - cl, 6) + 0e0 AS new_clip, round(b2 - bl, 6) + 0e0 AS crush, abs(l2 - luma) <= 5 AND c2 - cl <= 0 AND b2 - bl <= 0 AS pass FROM n WHERE l2 IS NOT NULL""")
def qc08(spark: SparkSession, sf: str) -> DataFrame:
    share = lambda f: 100 * F.size(F.filter("px", f)) / F.size("px")
    s = v.v_frames(spark, sf).select("clip_id", "frame_no", sg.mean(F.col("px")).alias("luma_before"), share(lambda x: x >= 235).alias("clip_before"), share(lambda x: x < 16).alias("black_before"))
    w = Window.partitionBy("clip_id").orderBy("frame_no")
    s = s.withColumns({f"{c}_after": F.lead(f"{c}_before").over(w) for c in ("luma", "clip", "black")}).filter("luma_after is not null")
    return r(qc.temporal_steps(s, 5.0, 0.0, 0.0).select("clip_id", "frame_no", "step", "new_clip", "crush", "pass"), "step", "new_clip", "crush")


@query("qc10_placement", "v_pixels", """, c AS (SELECT frame_no AS frame_id, greatest(3 * quantile_cont(v, 0.995) FILTER (WHERE NOT (y BETWEEN 2 AND 5 AND x BETWEEN 2 AND 5)), 40) AS cutoff FROM (SELECT frame_no, y, x, CASE WHEN (y BETWEEN 2 AND 5 AND x BETWEEN 2 AND 5) OR (frame_no % 7 = 0 AND y = 0 AND x = 1) THEN v ELSE v / 10e0 END AS v FROM v_pixels) GROUP BY 1),
p AS (SELECT frame_no AS frame_id, y, x, CASE WHEN (y BETWEEN 2 AND 5 AND x BETWEEN 2 AND 5) OR (frame_no % 7 = 0 AND y = 0 AND x = 1) THEN v ELSE v / 10e0 END AS v FROM v_pixels), g AS (SELECT p.frame_id, min(y) AS top, max(y) AS bottom, min(x) AS "left", max(x) AS "right", count(*) AS n, count(*) FILTER (WHERE NOT (y BETWEEN 2 AND 5 AND x BETWEEN 2 AND 5)) AS spill FROM p JOIN c USING (frame_id) WHERE v > cutoff GROUP BY 1)
SELECT frame_id, round(cutoff, 6) AS cutoff, top, bottom, "left", "right", n, spill, coalesce(spill = 0, false) AS contained FROM c LEFT JOIN g USING (frame_id)""")
def qc10(spark: SparkSession, sf: str) -> DataFrame:
    lit = (F.col("y").between(2, 5) & F.col("x").between(2, 5)) | ((F.col("frame_no") % 7 == 0) & (F.col("y") == 0) & (F.col("x") == 1))
    d = v.v_pixels(spark, sf).select(F.col("frame_no").alias("frame_id"), "y", "x", F.when(lit, F.col("v").cast("double")).otherwise(F.col("v") / 10.0).alias("v"))
    return r(qc.placement(d, (2, 2, 6, 6)), "cutoff")


@query("qc11_phase_match", "v_frames", """, e AS (SELECT r.frame_no AS region_id, t.frame_no AS k, list_sum(list_transform(list_zip(r.px, t.px), lambda z: abs(z[1] - z[2])::DOUBLE)) AS err FROM v_frames r, v_frames t WHERE t.frame_no < 16), b AS (SELECT region_id, min_by(k, (err, k)) AS k FROM e GROUP BY 1)
SELECT region_id, k, (floor(region_id / 25e0 * 10)::BIGINT % 16)::INTEGER AS expected, least((k - floor(region_id / 25e0 * 10)::BIGINT % 16 + 16) % 16, 16 - (k - floor(region_id / 25e0 * 10)::BIGINT % 16 + 16) % 16) AS delta, least((k - floor(region_id / 25e0 * 10)::BIGINT % 16 + 16) % 16, 16 - (k - floor(region_id / 25e0 * 10)::BIGINT % 16 + 16) % 16) <= 1 AS pass FROM b""")
def qc11(spark: SparkSession, sf: str) -> DataFrame:
    f = v.v_frames(spark, sf)
    return qc.phase_match(f.select(F.col("frame_no").alias("region_id"), (F.col("frame_no") / 25.0).alias("pts"), "px"), f.filter("frame_no < 16").select(F.col("frame_no").alias("k"), F.col("px").alias("tpx")), 16, 10.0)


@query("qc12_loop_and_alpha", "v_pixels", """, n AS (SELECT clip_id, CASE WHEN y < 2 THEN 'edge' WHEN y < 6 THEN 'solid' ELSE 'transparent' END AS band, v, lead(v, 4) OVER w AS l, lead(v, 2) OVER w AS h FROM v_pixels WINDOW w AS (PARTITION BY clip_id, y, x ORDER BY frame_no))
SELECT clip_id, band, round(avg(abs(v - l)), 6) AS d_loop, round(avg(abs(v - h)), 6) AS d_half, avg(abs(v - l)) < avg(abs(v - h)) / 2 AS loops FROM n WHERE l IS NOT NULL GROUP BY 1, 2""")
def qc12(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("clip_id", "y", "x").orderBy("frame_no")
    band = F.when(F.col("y") < 2, "edge").when(F.col("y") < 6, "solid").otherwise("transparent")
    p = v.v_pixels(spark, sf).select("clip_id", band.alias("band"), F.col("v").alias("now"), F.lead("v", 4).over(w).alias("after_loop"), F.lead("v", 2).over(w).alias("after_half")).filter("after_loop is not null")
    return r(qc.loop_and_alpha(p), "d_loop", "d_half")


@query("qc13_sample_plan", "v_cuts", f""", {TIMES}, t AS (SELECT job_id, round(max(proof_out), 6) AS e FROM tm GROUP BY 1), r AS (SELECT job_id, round(proof_in, 6) AS p FROM tm), a AS (SELECT job_id, unnest([p - 0.5, p + 0.5]) AS t FROM r WHERE p > 0 UNION ALL SELECT job_id, e * unnest([0.1::DOUBLE, 0.5::DOUBLE, 0.9::DOUBLE]) FROM t),
d AS (SELECT DISTINCT a.job_id, round(a.t, 3) AS t FROM a JOIN t USING (job_id) WHERE round(a.t, 3) >= 0 AND round(a.t, 3) <= e), n AS (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY t) - 1 AS i, count(*) OVER (PARTITION BY job_id) AS n FROM d) SELECT job_id, t FROM n WHERE i % ceil(n / 40)::BIGINT = 0""")
def qc13(spark: SparkSession, sf: str) -> DataFrame:
    return qc.sample_plan(r(timed(spark, sf), "proof_in", "proof_out"), (0.1, 0.5, 0.9), 0.5, 40)


CHECKS = """ex AS (SELECT o_orderkey AS subject, unnest(['status', 'total']) AS key, unnest([CASE WHEN o_orderkey % 4 = 0 THEN 'X' ELSE o_orderstatus END, (o_totalprice + o_orderkey % 3)::VARCHAR]) AS want, unnest([NULL, 1.5e0]) AS tol FROM orders), pb AS (SELECT o_orderkey AS subject, unnest(['status', 'total']) AS key, unnest([o_orderstatus, o_totalprice::VARCHAR]) AS got FROM orders),
ck AS (SELECT subject, key, coalesce(CASE WHEN tol IS NOT NULL THEN abs(got::DOUBLE - want::DOUBLE) <= tol ELSE got = want END, false) AS pass, CASE WHEN got IS NULL THEN 'absent' WHEN NOT coalesce(CASE WHEN tol IS NOT NULL THEN abs(got::DOUBLE - want::DOUBLE) <= tol ELSE got = want END, false) THEN 'differs' ELSE '' END AS why FROM ex LEFT JOIN (SELECT * FROM pb WHERE subject % 5 <> 0 OR key <> 'total') USING (subject, key))"""


def _checks(spark: SparkSession, sf: str) -> DataFrame:
    o, key = v.table(spark, sf, "orders"), F.col("o_orderkey")
    pair = lambda a, b: F.explode(F.array(a, b)).alias("p")
    part = lambda name, x, tol: F.struct(F.lit(name).alias("key"), x.cast("string").alias("want"), F.lit(tol).cast("double").alias("tolerance"))
    expected = o.select(key.alias("subject"), pair(part("status", F.when(key % 4 == 0, "X").otherwise(F.col("o_orderstatus")), None), part("total", F.col("o_totalprice") + key % 3, 1.5))).select("subject", "p.*")
    got = o.select(key.alias("subject"), pair(part("status", F.col("o_orderstatus"), None), part("total", F.col("o_totalprice"), None))).select("subject", "p.key", F.col("p.want").alias("got")).filter("subject % 5 <> 0 or key <> 'total'")
    return qc.delivery_check(got, expected)


@query("qc14_delivery_check", "", f"WITH {CHECKS} SELECT * FROM ck")
def qc14(spark: SparkSession, sf: str) -> DataFrame:
    return _checks(spark, sf)


@query("qc15_verdict", "", f"WITH {CHECKS}, g AS (SELECT subject, bool_and(pass) AS ok, string_agg(CASE WHEN NOT pass THEN key END, ',' ORDER BY key) AS f FROM ck WHERE subject % 6 <> 0 GROUP BY 1) SELECT o_orderkey AS subject, CASE WHEN ok IS NULL THEN 'ERROR' WHEN ok THEN 'PASS' ELSE 'FAIL' END AS verdict, coalesce(f, '') AS failed FROM orders LEFT JOIN g ON g.subject = o_orderkey")
def qc15(spark: SparkSession, sf: str) -> DataFrame:
    c = _checks(spark, sf).filter("subject % 6 <> 0").withColumnRenamed("key", "name")
    return qc.verdict(c, v.table(spark, sf, "orders").select(F.col("o_orderkey").alias("subject")))
