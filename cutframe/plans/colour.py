"""COL rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import colour as co
from ..operators.signals import rgb_stats
from ..sources import views as v
from . import query
from .signals import RGB
from .timeline import r

PROFILE = "pf AS (SELECT clip_id, 100 * count(*) FILTER (WHERE v < 24) / count(*) AS dark_pct, 100 * count(*) FILTER (WHERE v > 235) / count(*) AS blown_pct, quantile_cont(v, 0.1) / 255 AS p10, quantile_cont(v, 0.5) / 255 AS p50, quantile_cont(v, 0.9) / 255 AS p90, avg(v) / 255 AS mean FROM v_pixels GROUP BY 1)"
SKEWED = PROFILE + ", ps AS (SELECT clip_id, dark_pct * (clip_id % 3) AS dark_pct, blown_pct, p10 * (1 + clip_id % 4) / 2 AS p10, p90 * (1 + clip_id % 3) / 2 AS p90, mean FROM pf)"


def profile(spark: SparkSession, sf: str) -> DataFrame:
    return co.luma_profile(v.v_frames(spark, sf))


def skewed(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles spread out so that each class occurs."""
    c = F.col("clip_id")
    return profile(spark, sf).select("clip_id", (F.col("dark_pct") * (c % 3)).alias("dark_pct"), "blown_pct", (F.col("p10") * (1 + c % 4) / 2).alias("p10"), (F.col("p90") * (1 + c % 3) / 2).alias("p90"), "mean")


@query("col01_luma_profile", "v_pixels", f", {PROFILE} SELECT clip_id, round(dark_pct, 8) AS dark_pct, round(blown_pct, 8) AS blown_pct, round(p10, 8) AS p10, round(p50, 8) AS p50, round(p90, 8) AS p90, round(mean, 8) AS mean FROM pf")
def col01(spark: SparkSession, sf: str) -> DataFrame:
    return r(profile(spark, sf), "dark_pct", "blown_pct", "p10", "p50", "p90", "mean", digits=8)


ABS = "ab AS (SELECT *, CASE WHEN p90 < 0.55 OR dark_pct > 8 OR mean < 0.38 THEN 'underexposed' WHEN blown_pct > 2 OR mean > 0.62 THEN 'overexposed' ELSE 'normal' END AS label FROM ps)"


@query("col02_classify_absolute", "v_pixels", f""", {SKEWED}, {ABS} SELECT clip_id, label, CASE label WHEN 'underexposed' THEN array_to_string(list_filter([CASE WHEN p90 < 0.55 THEN 'no_highlights' END, CASE WHEN dark_pct > 8 THEN 'crushed' END, CASE WHEN mean < 0.38 THEN 'low_mean' END], lambda x: x IS NOT NULL), ',')
WHEN 'overexposed' THEN array_to_string(list_filter([CASE WHEN blown_pct > 2 THEN 'blown' END, CASE WHEN mean > 0.62 THEN 'high_mean' END], lambda x: x IS NOT NULL), ',') ELSE '' END AS reasons FROM ab""")
def col02(spark: SparkSession, sf: str) -> DataFrame:
    return co.classify_absolute(skewed(spark, sf)).select("clip_id", "label", "reasons")


@query("col03_classify_relative", "v_pixels", f", {SKEWED}, rf AS (SELECT clip_id // 4 AS job_id, p10 AS r10, p90 AS r90 FROM ps WHERE clip_id % 4 = 1) SELECT clip_id, CASE WHEN r90 <= 0 THEN 'normal' WHEN p90 / r90 < 0.75 OR p10 / greatest(r10, 1e-4) < 0.75 THEN 'underexposed' WHEN p10 / greatest(r10, 1e-4) > 1.6 OR p90 / r90 > 1.5 THEN 'overexposed' ELSE 'normal' END AS label FROM ps JOIN rf ON job_id = clip_id // 4")
def col03(spark: SparkSession, sf: str) -> DataFrame:
    p = skewed(spark, sf).withColumn("job_id", F.expr("clip_id div 4"))
    ref = p.filter("clip_id % 4 = 1").select("job_id", F.col("p10").alias("r10"), F.col("p90").alias("r90"))
    return co.classify_relative(p, ref).select("clip_id", "label")


@query("col04_corrective_points", "v_pixels", f""", {SKEWED}, {ABS}, rw AS (SELECT clip_id, CASE label WHEN 'underexposed' THEN [{{'x': 0e0, 'y': 0.03e0}}, {{'x': least(p10, 0.25e0), 'y': 0.12e0}}, {{'x': least(p90, 0.9e0), 'y': 0.8e0}}, {{'x': 1e0, 'y': 1e0}}] WHEN 'overexposed' THEN [{{'x': 0e0, 'y': 0e0}}, {{'x': least(p10, 0.3e0), 'y': greatest(p10 * 0.9e0, 0.05e0)}}, {{'x': least(p90, 0.98e0), 'y': least(0.8e0, p90 * 0.85e0)}}, {{'x': 1e0, 'y': 1e0}}] END AS ps FROM ab WHERE label <> 'normal'),
un AS (SELECT clip_id, p.x AS x, p.y AS y FROM (SELECT clip_id, unnest(ps) AS p FROM rw)), dd AS (SELECT clip_id, x, min(y) AS y FROM un GROUP BY 1, 2)
SELECT clip_id, row_number() OVER (PARTITION BY clip_id ORDER BY x) - 1 AS i, round(x, 8) AS x, round(max(y) OVER (PARTITION BY clip_id ORDER BY x), 8) AS y FROM dd""")
def col04(spark: SparkSession, sf: str) -> DataFrame:
    p = co.corrective_points(co.classify_absolute(skewed(spark, sf)))
    return r(p.select("clip_id", F.posexplode("points").alias("i", "p")).select("clip_id", F.col("i").cast("bigint").alias("i"), "p.x", "p.y"), "x", "y", digits=8)


POINTS = "cp AS (SELECT clip_id AS match_id, t, CASE k % 3 WHEN 0 THEN 'r' WHEN 1 THEN 'g' ELSE 'b' END AS ch, j AS i, j / 4e0 AS x, (sig % (5 + j)) / (5 + j) AS y FROM v_samples, (SELECT unnest([0, 1, 2]) AS j) WHERE kind = 'view')"


def curves(spark: SparkSession, sf: str) -> DataFrame:
    s = v.v_samples(spark, sf).filter("kind = 'view'").withColumn("i", F.explode(F.array(*(F.lit(j) for j in range(3)))))
    k = F.col("k") % 3
    return s.select(F.col("clip_id").alias("match_id"), "t", F.when(k == 0, "r").when(k == 1, "g").otherwise("b").alias("ch"), "i", (F.col("i") / 4.0).alias("x"), ((F.col("sig") % (5 + F.col("i"))) / (5 + F.col("i"))).alias("y"))


@query("col06_curve_at", "v_samples", f""", {POINTS}, tm AS (SELECT clip_id AS match_id, t AS at_s FROM v_samples WHERE kind = 'click'), g AS (SELECT DISTINCT match_id, t FROM cp),
b0 AS (SELECT tm.*, p.t AS p FROM tm ASOF LEFT JOIN g p ON p.match_id = tm.match_id AND tm.at_s >= p.t), b1 AS (SELECT b0.*, n.t AS n FROM b0 ASOF LEFT JOIN g n ON n.match_id = b0.match_id AND b0.at_s <= n.t),
b AS (SELECT match_id, at_s, coalesce(p, n) AS t0, coalesce(n, p) AS t1, CASE WHEN coalesce(n, p) > coalesce(p, n) THEN (at_s - coalesce(p, n)) / (coalesce(n, p) - coalesce(p, n)) ELSE 0 END AS u FROM b1 WHERE coalesce(p, n) IS NOT NULL),
l AS (SELECT b.match_id, b.at_s, u, ch, i, x, y FROM b JOIN cp ON cp.match_id = b.match_id AND cp.t = b.t0), rr AS (SELECT b.match_id, b.at_s, u, ch, i, x, y FROM b JOIN cp ON cp.match_id = b.match_id AND cp.t = b.t1)
SELECT match_id, at_s, ch, i, round(CASE WHEN l.x IS NULL THEN rr.x WHEN rr.x IS NULL THEN l.x ELSE l.x + (rr.x - l.x) * l.u END, 8) AS x, round(CASE WHEN l.y IS NULL THEN rr.y WHEN rr.y IS NULL THEN l.y ELSE l.y + (rr.y - l.y) * l.u END, 8) AS y FROM l FULL JOIN rr USING (match_id, at_s, ch, i)""")
def col06(spark: SparkSession, sf: str) -> DataFrame:
    times = v.v_samples(spark, sf).filter("kind = 'click'").select(F.col("clip_id").alias("match_id"), F.col("t").alias("at"))
    return r(co.curve_at(curves(spark, sf), times), "x", "y", digits=8).withColumnRenamed("at", "at_s")


LUT = "lt AS (SELECT ch, v, least(255e0, v * v / 255e0 + (ch * 7) % 11) AS out FROM (SELECT unnest(range(0, 256))::INTEGER AS v), (SELECT DISTINCT label % 3 AS ch FROM embeddings)), gn AS (SELECT label % 3 AS ch, 0.8e0 + (count(*) % 50) / 100e0 AS gain FROM embeddings GROUP BY 1)"


def lut_and_gains(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    e = v.table(spark, sf, "embeddings").withColumn("ch", F.col("label") % 3)
    lut = e.select("ch").distinct().withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(255))))
    lut = lut.withColumn("out", F.least(F.lit(255.0), F.col("v") * F.col("v") / 255.0 + (F.col("ch") * 7) % 11))
    return lut, e.groupBy("ch").agg((0.8 + (F.count("*") % 50) / 100.0).alias("gain"))


@query("col07_invert_lut", "", f"""WITH {LUT}, xs AS (SELECT unnest(range(0, 33)) AS k), x2 AS (SELECT k, k * 255e0 / 32 AS x FROM xs), w AS (SELECT a.ch, k, x, greatest(0, least(255, gain * (a.out + (b.out - a.out) * (x - a.v)))) AS want FROM x2 JOIN lt a ON a.v = floor(x) JOIN lt b ON b.ch = a.ch AND b.v = ceil(x) JOIN gn ON gn.ch = a.ch),
bb AS (SELECT w.ch, k, x, min_by(v, (round(abs(out - want), 9), v)) AS y FROM w JOIN lt USING (ch) GROUP BY 1, 2, 3) SELECT ch, k, x, max(y) OVER (PARTITION BY ch ORDER BY k) AS y FROM bb""")
def col07(spark: SparkSession, sf: str) -> DataFrame:
    return co.invert_lut(*lut_and_gains(spark, sf))


def _fit(rounds: int) -> str:
    """SQL for the states st0 ... after each round of the gain fit."""
    measure = "SELECT s.window_id, s.ch, sum(lt.out * h.n) / sum(h.n) AS m FROM {st} s JOIN hg h USING (window_id, ch) JOIN lt ON lt.ch = s.ch AND lt.v = least(255, floor(h.v * s.gain + 0.5::DOUBLE)) GROUP BY 1, 2"
    step = "st{k} AS (SELECT window_id, ch, target, CASE WHEN m IS NULL OR m = 0 OR abs(round(target / m, 9) - 1) <= 0.01::DOUBLE THEN gain ELSE gain * round(target / m, 9) END AS gain FROM {st} JOIN ({measure}) USING (window_id, ch))"
    return ", ".join(step.format(k=k + 1, st=f"st{k}", measure=measure.format(st=f"st{k}")) for k in range(rounds))


@query("col08_fit_gains", "v_pixels", f""", {LUT}, hg AS (SELECT clip_id AS window_id, (clip_id % 3)::INTEGER AS ch, v, count(*) AS n FROM v_pixels GROUP BY 1, 2, 3),
st0 AS (SELECT DISTINCT window_id, ch, 60 + window_id * 3e0 AS target, 1e0 AS gain FROM hg), {_fit(4)} SELECT window_id, ch, target, round(gain, 6) AS gain FROM st4""")
def col08(spark: SparkSession, sf: str) -> DataFrame:
    lut, _ = lut_and_gains(spark, sf)
    px = v.v_pixels(spark, sf).withColumn("ch", (F.col("clip_id") % 3).cast("int"))
    hist = px.groupBy(F.col("clip_id").alias("window_id"), "ch", "v").agg(F.count("*").alias("n"))
    targets = hist.select("window_id", "ch").distinct().withColumn("target", 60.0 + F.col("window_id") * 3)
    return r(co.fit_gains(hist, lut, targets), "gain")


@query("col09_solve_schedule", "v_cards", "SELECT reel, CASE WHEN k % 2 = 0 THEN 'fit' ELSE 'held_out' END AS part, (k // 2)::INTEGER AS i, round(length * (k + 0.5e0) / 8, 6) AS t FROM (SELECT reel, sum(duration_s) AS length FROM v_cards GROUP BY 1), (SELECT unnest(range(0, 8)) AS k)")
def col09(spark: SparkSession, sf: str) -> DataFrame:
    reels = v.v_cards(spark, sf).groupBy("reel").agg(F.sum("duration_s").alias("length"))
    return r(co.solve_schedule(reels, 4), "t")


@query("col10_band_gate", "v_rgb", f""", {RGB}, s AS (SELECT clip_id, frame_no, CASE clip_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS angle, luma709, y95, clipped_pct, black_pct, chroma FROM rs JOIN qy USING (clip_id, frame_no)),
b(angle, ll, lh, p, c, k, sl, sh) AS (VALUES ('A', 120, 135, 190, 0.3, 0, 60, 90), ('B', 110, 128, 180, 5, 2, 70, 80))
SELECT clip_id, frame_no, array_to_string(list_filter([CASE WHEN NOT luma709 BETWEEN ll AND lh THEN 'luma' END, CASE WHEN y95 > p THEN 'p95' END, CASE WHEN clipped_pct > c THEN 'clipped' END, CASE WHEN black_pct < k THEN 'black' END, CASE WHEN NOT chroma BETWEEN sl AND sh THEN 'sat' END], lambda x: x IS NOT NULL), ',') AS failures FROM s JOIN b USING (angle)""")
def col10(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("clip_id") % 3
    s = rgb_stats(v.v_rgb(spark, sf)).select("clip_id", "frame_no", F.when(k == 0, "A").when(k == 1, "B").otherwise("C").alias("angle"), F.col("luma709").alias("luma_mean"), F.col("y95").alias("p95"), "clipped_pct", "black_pct", F.col("chroma").alias("sat"))
    bands = spark.createDataFrame([("A", 120.0, 135.0, 190.0, 0.3, 0.0, 60.0, 90.0), ("B", 110.0, 128.0, 180.0, 5.0, 2.0, 70.0, 80.0)], "angle string, luma_lo double, luma_hi double, p95_max double, clipped_max double, black_min double, sat_lo double, sat_hi double")
    return co.band_gate(s, bands).select("clip_id", "frame_no", "failures")


@query("col11_shadow_gain", "v_samples", f", {POINTS}, s AS (SELECT *, lead(x) OVER w AS x1, lead(y) OVER w AS y1 FROM cp WINDOW w AS (PARTITION BY match_id, t, ch ORDER BY x, i)) SELECT match_id, round(max((y + (y1 - y) * (0.05::DOUBLE - x) / (x1 - x)) / 0.05::DOUBLE), 8) AS gain FROM s WHERE x <= 0.05 AND x1 > 0.05 GROUP BY 1")
def col11(spark: SparkSession, sf: str) -> DataFrame:
    return r(co.shadow_gain(curves(spark, sf)), "gain", digits=8)


@query("col12_chain_report", "v_samples", """, s AS (SELECT clip_id AS job_id, CASE WHEN k % 2 = 0 THEN 'A' ELSE 'B' END AS angle, CASE k % 5 WHEN 0 THEN 'match_' ELSE 'stage_' END || k AS stage, sig / 40 AS shadow, k = 77 AS converts FROM v_samples WHERE clip_id % 2 = 0 OR k > 80), g AS (SELECT job_id, angle, count(*) FILTER (WHERE shadow > 1.5) AS l, count(*) - count(DISTINCT stage) AS a, bool_or(converts) AS c, bool_or(stage LIKE 'match%') AS m FROM s GROUP BY 1, 2)
SELECT * FROM (SELECT job_id, angle, unnest([CASE WHEN l >= 2 THEN 'double_lift' END, CASE WHEN a > 0 THEN 'duplicate_stage' END, CASE WHEN c THEN 'range_conversion' END, CASE WHEN NOT m THEN 'no_match' END]) AS problem FROM g) WHERE problem IS NOT NULL""")
def col12(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("k")
    s = v.v_samples(spark, sf).filter("clip_id % 2 = 0 or k > 80")
    return co.chain_report(s.select(F.col("clip_id").alias("job_id"), F.when(k % 2 == 0, "A").otherwise("B").alias("angle"), F.concat(F.when(k % 5 == 0, "match_").otherwise("stage_"), k.cast("string")).alias("stage"), (F.col("sig") / 40).alias("shadow"), (k == 77).alias("converts")))


@query("col13_match_provenance", "v_clips", """, a AS (SELECT dir AS job_id, lang AS angle, clip_id AS idx, CASE WHEN dir = 'src4' AND clip_id % 50 = 4 THEN ' ' ELSE 'r=' || clip_id || '  x' END AS form FROM v_clips WHERE dir <> 'src1' OR lang <> 'en'), b AS (SELECT dir AS job_id, lang AS angle, clip_id AS idx, CASE WHEN dir = 'src2' AND lang = 'en' THEN 'other' WHEN dir = 'src4' AND clip_id % 50 = 4 THEN ' ' ELSE ' R=' || clip_id || ' X ' END AS form FROM v_clips WHERE NOT (dir = 'src3' AND clip_id % 40 = 3)),
n AS (SELECT job_id, angle, idx, lower(regexp_replace(trim(a.form), '\\s+', ' ', 'g')) AS v, lower(regexp_replace(trim(b.form), '\\s+', ' ', 'g')) AS s FROM a FULL JOIN b USING (job_id, angle, idx)), g AS (SELECT job_id, angle, count(v) AS nv, count(s) AS ns, bool_or(coalesce(v = '', false) OR coalesce(s = '', false)) AS e, bool_and(coalesce(v = s, false)) AS same FROM n GROUP BY 1, 2)
SELECT job_id, angle, CASE WHEN nv = 0 OR ns = 0 THEN 'absent' WHEN nv <> ns THEN 'count_mismatch' WHEN e THEN 'empty' WHEN same THEN 'ok' ELSE 'mismatch' END AS state FROM g""")
def col13(spark: SparkSession, sf: str) -> DataFrame:
    c = v.v_clips(spark, sf).select(F.col("dir").alias("job_id"), F.col("lang").alias("angle"), F.col("clip_id").alias("idx"))
    empty = (F.col("job_id") == "src4") & (F.col("idx") % 50 == 4)
    a = c.filter("job_id <> 'src1' or angle <> 'en'").withColumn("form", F.when(empty, " ").otherwise(F.concat(F.lit("r="), F.col("idx").cast("string"), F.lit("  x"))))
    b = c.filter("not (job_id = 'src3' and idx % 40 = 3)").withColumn("form", F.when((F.col("job_id") == "src2") & (F.col("angle") == "en"), "other").when(empty, " ").otherwise(F.concat(F.lit(" R="), F.col("idx").cast("string"), F.lit(" X "))))
    return co.match_provenance(a, b)


@query("col05_pregrade_plan", "v_pixels v_cuts", f""", {SKEWED}, u AS (SELECT DISTINCT job_id, angle, CASE WHEN angle = 'A' THEN job_id % 10 ELSE (job_id + pos % 3) % 12 END AS source FROM v_cuts), x AS (SELECT u.*, p10, p90 FROM u LEFT JOIN ps ON ps.clip_id = u.source), rf AS (SELECT job_id, min_by(p10, source) AS r10, min_by(p90, source) AS r90 FROM x WHERE angle = 'A' GROUP BY 1)
SELECT x.job_id, x.angle, x.source, CASE WHEN angle = 'A' THEN 'reference' WHEN x.job_id % 7 = 0 AND x.source % 2 = 0 THEN 'declared' WHEN p10 IS NULL OR r10 IS NULL THEN 'unmeasured' WHEN r90 <= 0 THEN 'normal' WHEN p90 / r90 < 0.75 OR p10 / greatest(r10, 1e-4) < 0.75 THEN 'underexposed' WHEN p10 / greatest(r10, 1e-4) > 1.6 OR p90 / r90 > 1.5 THEN 'overexposed' ELSE 'normal' END AS plan FROM x LEFT JOIN rf USING (job_id)""")
def col05(spark: SparkSession, sf: str) -> DataFrame:
    job = F.col("job_id")
    spans = v.v_cuts(spark, sf).select("job_id", "angle", F.when(F.col("angle") == "A", job % 10).otherwise((job + F.col("pos") % 3) % 12).alias("source"))
    declared = spans.filter("job_id % 7 = 0 and source % 2 = 0")
    return co.pregrade_plan(spans, skewed(spark, sf).withColumnRenamed("clip_id", "source"), declared)


@query("qc09_transform_steps", "v_samples", f""", {POINTS}, jn AS (SELECT clip_id AS match_id, t AS j FROM v_samples WHERE kind = 'click' AND k % 4 = 0), tm AS (SELECT match_id, j, unnest(['before', 'after']) AS side, unnest([j - 2, j + 2]) AS at_s FROM jn), tt AS (SELECT DISTINCT match_id, at_s FROM tm), g AS (SELECT DISTINCT match_id, t FROM cp),
b0 AS (SELECT tt.*, p.t AS p FROM tt ASOF LEFT JOIN g p ON p.match_id = tt.match_id AND tt.at_s >= p.t), b1 AS (SELECT b0.*, n.t AS n FROM b0 ASOF LEFT JOIN g n ON n.match_id = b0.match_id AND b0.at_s <= n.t),
b AS (SELECT match_id, at_s, coalesce(p, n) AS t0, coalesce(n, p) AS t1, CASE WHEN coalesce(n, p) > coalesce(p, n) THEN (at_s - coalesce(p, n)) / (coalesce(n, p) - coalesce(p, n)) ELSE 0 END AS u FROM b1 WHERE coalesce(p, n) IS NOT NULL),
l AS (SELECT b.match_id, b.at_s, u, ch, i, x, y FROM b JOIN cp ON cp.match_id = b.match_id AND cp.t = b.t0), rr AS (SELECT b.match_id, b.at_s, u, ch, i, x, y FROM b JOIN cp ON cp.match_id = b.match_id AND cp.t = b.t1),
cv AS (SELECT match_id, at_s, ch, i, CASE WHEN l.x IS NULL THEN rr.x WHEN rr.x IS NULL THEN l.x ELSE l.x + (rr.x - l.x) * l.u END AS x, CASE WHEN l.y IS NULL THEN rr.y WHEN rr.y IS NULL THEN l.y ELSE l.y + (rr.y - l.y) * l.u END AS y FROM l FULL JOIN rr USING (match_id, at_s, ch, i)),
sg AS (SELECT *, lead(x) OVER w AS x1, lead(y) OVER w AS y1, row_number() OVER w = 1 AS f FROM cv WINDOW w AS (PARTITION BY match_id, at_s, ch ORDER BY x, i)), lv AS (SELECT unnest(['r', 'g', 'b']) AS ch, 0.2e0 AS v UNION ALL SELECT unnest(['r', 'g', 'b']), 0.4e0),
sh AS (SELECT t.match_id, t.j, t.side, s.ch, lv.v, CASE WHEN x1 IS NULL OR v < x THEN y ELSE y + (y1 - y) * (v - x) / (x1 - x) END AS yy FROM tm t JOIN sg s ON s.match_id = t.match_id AND s.at_s = t.at_s JOIN lv ON lv.ch = s.ch WHERE (v >= x AND (x1 IS NULL OR v < x1)) OR (f AND v < x)),
gg AS (SELECT match_id, j, ch, v, max(yy) FILTER (WHERE side = 'before') AS b, max(yy) FILTER (WHERE side = 'after') AS a FROM sh GROUP BY 1, 2, 3, 4) SELECT match_id, j, round(max(abs(a - b)), 6) AS step, coalesce(round(max(abs(a - b)), 6) <= 0.1, false) AS pass FROM gg GROUP BY 1, 2""")
def qc09(spark: SparkSession, sf: str) -> DataFrame:
    joins = v.v_samples(spark, sf).filter("kind = 'click' and k % 4 = 0").select(F.col("clip_id").alias("match_id"), F.col("t").alias("j"))
    levels = joins.select("match_id").distinct().withColumn("ch", F.explode(F.array(*(F.lit(c) for c in "rgb")))).withColumn("v", F.explode(F.array(F.lit(0.2), F.lit(0.4))))
    return co.transform_steps(levels, curves(spark, sf), joins, 2.0, 0.1)
