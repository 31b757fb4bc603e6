"""Exposure and camera-match analytics. Luma is 0..255; curve points (match_id, t, ch, i, x, y) and terms by time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.blocks import around

#: The absolute target band, as shares of full scale and percents.
DARK_MAX, BLOWN_MAX, P90_MIN, MEAN_MIN, MEAN_MAX = 8.0, 2.0, 0.55, 0.38, 0.62


def luma_profile(frames: DataFrame) -> DataFrame:
    """Per source (clip_id, px): percent dark (< 24) and blown (> 235), and p10, p50, p90, mean as shares of 255."""
    v = frames.select("clip_id", F.explode("px").alias("v"))
    share = lambda c: 100 * F.count_if(c) / F.count("*")
    q = lambda p: F.percentile("v", p) / 255
    return v.groupBy("clip_id").agg(share(F.col("v") < 24).alias("dark_pct"), share(F.col("v") > 235).alias("blown_pct"), q(0.1).alias("p10"), q(0.5).alias("p50"), q(0.9).alias("p90"), (F.avg("v") / 255).alias("mean"))


def _named(**rules: Column) -> Column:
    return F.array_join(F.filter(F.array(*(F.when(c, n) for n, c in rules.items())), lambda x: x.isNotNull()), ",")


def classify_absolute(profiles: DataFrame) -> DataFrame:
    """label and reasons against the built-in target band; too little light is looked for first."""
    low_p90, dark, low_mean = F.col("p90") < P90_MIN, F.col("dark_pct") > DARK_MAX, F.col("mean") < MEAN_MIN
    blown, high_mean = F.col("blown_pct") > BLOWN_MAX, F.col("mean") > MEAN_MAX
    under, over = low_p90 | dark | low_mean, blown | high_mean
    label = F.when(under, "underexposed").when(over, "overexposed").otherwise("normal")
    reasons = F.when(under, _named(no_highlights=low_p90, crushed=dark, low_mean=low_mean)).when(over, _named(blown=blown, high_mean=high_mean)).otherwise("")
    return profiles.withColumns({"label": label, "reasons": reasons})


def classify_relative(profiles: DataFrame, reference: DataFrame) -> DataFrame:
    """label against a job's reference (job_id, r10, r90): under 0.75 of either quantile, over 1.6 or 1.5; a reference without light classifies nothing."""
    rows = profiles.join(reference, "job_id")
    d10, d90 = F.col("p10") / F.greatest("r10", F.lit(1e-4)), F.try_divide("p90", "r90")
    label = F.when(F.col("r90") <= 0, "normal").when((d90 < 0.75) | (d10 < 0.75), "underexposed").when((d10 > 1.6) | (d90 > 1.5), "overexposed").otherwise("normal")
    return rows.withColumn("label", label)


def corrective_points(classified: DataFrame) -> DataFrame:
    """points: control points (x, y) that bring p10 and p90 onto the target 0.12 and 0.80; sorted, rising x, y carried monotone; none where normal."""
    p10, p90 = F.col("p10"), F.col("p90")
    point = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    under = F.array(point(F.lit(0.0), F.lit(0.03)), point(F.least(p10, F.lit(0.25)), F.lit(0.12)), point(F.least(p90, F.lit(0.9)), F.lit(0.8)), point(F.lit(1.0), F.lit(1.0)))
    over = F.array(point(F.lit(0.0), F.lit(0.0)), point(F.least(p10, F.lit(0.3)), F.greatest(p10 * 0.9, F.lit(0.05))), point(F.least(p90, F.lit(0.98)), F.least(F.lit(0.8), p90 * 0.85)), point(F.lit(1.0), F.lit(1.0)))
    raw = F.array_sort(F.when(F.col("label") == "underexposed", under).when(F.col("label") == "overexposed", over))
    none = F.array().cast("array<struct<x:double,y:double>>")

    def step(kept: Column, p: Column) -> Column:
        last = F.element_at(kept, -1)
        return F.when(F.size(kept) == 0, F.array(p)).when(p["x"] <= last["x"], kept).otherwise(F.array_append(kept, F.struct(p["x"].alias("x"), F.greatest(p["y"], last["y"]).alias("y"))))

    return classified.withColumn("points", F.when(F.col("label") == "normal", none).otherwise(F.aggregate(raw, none, step)))


def curve_at(points: DataFrame, times: DataFrame) -> DataFrame:
    """Curve points at given times (match_id, at): held outside, blended linearly between control times, channel by channel and index by index.

    A point that only one bracketing control time has holds its value.
    """
    grid = points.select("match_id", F.col("t").alias("ct")).distinct()
    both = around(times, grid, "match_id", "at", "ct")
    both = both.withColumns({"t0": F.coalesce("prev_ct", "next_ct"), "t1": F.coalesce("next_ct", "prev_ct")}).filter("t0 is not null")
    u = F.when(F.col("t1") > F.col("t0"), (F.col("at") - F.col("t0")) / (F.col("t1") - F.col("t0"))).otherwise(F.lit(0.0))
    both = both.select("match_id", "at", "t0", "t1", u.alias("u"))
    p = points.select("match_id", F.col("t").alias("t0"), "ch", "i", F.col("x").alias("x0"), F.col("y").alias("y0"))
    q = points.select("match_id", F.col("t").alias("t1"), "ch", "i", F.col("x").alias("x1"), F.col("y").alias("y1"))
    left = both.join(p, ["match_id", "t0"])
    right = both.join(q, ["match_id", "t1"]).select("match_id", "at", "ch", "i", "x1", "y1", F.col("u").alias("_u"))
    joined = left.join(right, ["match_id", "at", "ch", "i"], "full")
    blend = lambda a, b: F.when(F.col(a).isNull(), F.col(b)).when(F.col(b).isNull(), F.col(a)).otherwise(F.col(a) + (F.col(b) - F.col(a)) * F.coalesce("u", "_u"))
    return joined.select("match_id", "at", "ch", "i", blend("x0", "x1").alias("x"), blend("y0", "y1").alias("y"))


def invert_lut(lut: DataFrame, gains: DataFrame, points: int = 33) -> DataFrame:
    """For each channel and each of `points` inputs: the first table entry nearest to gain * table(input), made monotone.

    lut(ch, v, out) has 256 rows a channel, gains(ch, gain) one; the cross product is points x 256 a channel.
    """
    xs = lut.sparkSession.range(points).select(F.col("id").alias("k"), (F.col("id") * 255.0 / (points - 1)).alias("x"))
    want = xs.withColumns({"v0": F.floor("x").cast("int"), "v1": F.ceil("x").cast("int")}).join(lut.select("ch", F.col("v").alias("v0"), F.col("out").alias("o0")), "v0").join(lut.select("ch", F.col("v").alias("v1"), F.col("out").alias("o1")), ["ch", "v1"]).join(gains, "ch")
    want = want.select("ch", "k", "x", F.greatest(F.lit(0.0), F.least(F.lit(255.0), F.col("gain") * (F.col("o0") + (F.col("o1") - F.col("o0")) * (F.col("x") - F.col("v0"))))).alias("want"))
    best = want.join(lut, "ch").groupBy("ch", "k", "x").agg(F.min_by("v", F.struct(F.round(F.abs(F.col("out") - F.col("want")), 9), "v")).alias("y"))
    w = Window.partitionBy("ch").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    return best.select("ch", "k", "x", F.max("y").over(w).alias("y"))


def fit_gains(hist: DataFrame, lut: DataFrame, targets: DataFrame, rounds: int = 4) -> DataFrame:
    """Per window and channel, the gain that brings the mean of lut(gain * v) to its target: multiplied by target / measured each round, at most `rounds`, held within 1 %.

    hist(window_id, ch, v, n): pixels reduced to 256-bin histograms, so a round costs a join of histogram rows only.
    """
    state = targets.select("window_id", "ch", "target", F.lit(1.0).alias("gain"))
    for _ in range(rounds):
        at = F.least(F.lit(255), F.floor(F.col("v") * F.col("gain") + 0.5).cast("int"))
        shown = hist.join(state, ["window_id", "ch"]).withColumn("v2", at).join(lut.select("ch", F.col("v").alias("v2"), "out"), ["ch", "v2"])
        measured = shown.groupBy("window_id", "ch").agg((F.sum(F.col("out") * F.col("n")) / F.sum("n")).alias("m"))
        ratio = F.round(F.try_divide("target", "m"), 9)
        gain = F.when(ratio.isNull() | (F.abs(ratio - 1) <= 0.01), F.col("gain")).otherwise(F.col("gain") * ratio)
        state = state.join(measured, ["window_id", "ch"]).select("window_id", "ch", "target", gain.alias("gain"))
    return state


def solve_schedule(reels: DataFrame, n: int) -> DataFrame:
    """n fitting and n held-out instants of each reel (reel, length), interleaved evenly."""
    k = F.explode(F.sequence(F.lit(0), F.lit(2 * n - 1)))
    return reels.withColumn("k", k).select("reel", F.when(F.col("k") % 2 == 0, "fit").otherwise("held_out").alias("part"), F.floor(F.col("k") / 2).cast("int").alias("i"), (F.col("length") * (F.col("k") + 0.5) / (2 * n)).alias("t"))


def band_gate(stats: DataFrame, bands: DataFrame) -> DataFrame:
    """Per segment: failures against its angle's band, comma-joined, and whether it passes; angles without a band aren't judged.

    stats(..., angle, luma_mean, p95, clipped_pct, black_pct, sat), bands(angle, luma_lo, luma_hi, p95_max, clipped_max, black_min, sat_lo, sat_hi)
    """
    rows = stats.join(F.broadcast(bands), "angle")  # one row an angle
    failures = _named(
        luma=~F.col("luma_mean").between(F.col("luma_lo"), F.col("luma_hi")),
        p95=F.col("p95") > F.col("p95_max"),
        clipped=F.col("clipped_pct") > F.col("clipped_max"),
        black=F.col("black_pct") < F.col("black_min"),
        sat=~F.col("sat").between(F.col("sat_lo"), F.col("sat_hi")),
    )
    return rows.select(*stats.columns, failures.alias("failures")).withColumn("pass", F.col("failures") == "")


def shadow_gain(points: DataFrame, x: float = 0.05) -> DataFrame:
    """Per match: the greatest y(x) / x over its channels and control times, by linear interpolation."""
    w = Window.partitionBy("match_id", "t", "ch").orderBy("x", "i")
    seg = points.withColumns({"x1": F.lead("x").over(w), "y1": F.lead("y").over(w)}).filter((F.col("x") <= x) & (F.col("x1") > x))
    y = F.col("y") + (F.col("y1") - F.col("y")) * (x - F.col("x")) / (F.col("x1") - F.col("x"))
    return seg.groupBy("match_id").agg(F.max(y / x).alias("gain"))


def chain_report(stages: DataFrame) -> DataFrame:
    """job_id, angle, problem for effective chains (job_id, angle, stage, shadow, converts): shadows lifted twice, a stage twice, unexpected range conversion, no match."""
    g = stages.groupBy("job_id", "angle").agg(F.count_if(F.col("shadow") > 1.5).alias("lifts"), (F.count("*") - F.count_distinct("stage")).alias("again"), F.bool_or("converts").alias("converts"), F.bool_or(F.col("stage").rlike("^match")).alias("matched"))
    rules = F.array(F.when(F.col("lifts") >= 2, "double_lift"), F.when(F.col("again") > 0, "duplicate_stage"), F.when(F.col("converts"), "range_conversion"), F.when(~F.col("matched"), "no_match"))
    return g.select("job_id", "angle", F.explode(rules).alias("problem")).filter("problem is not null")


def match_provenance(validated: DataFrame, shipping: DataFrame) -> DataFrame:
    """Per job and angle, validated against shipping matches (job_id, angle, idx, form): absent, count_mismatch, empty, mismatch or ok, by the hash of the canonical form."""
    canon = lambda c: F.sha2(F.regexp_replace(F.lower(F.trim(c)), r"\s+", " "), 256)
    a = validated.select("job_id", "angle", "idx", canon(F.col("form")).alias("v"), (F.trim("form") == "").alias("e1"))
    b = shipping.select("job_id", "angle", "idx", canon(F.col("form")).alias("s"), (F.trim("form") == "").alias("e2"))
    g = a.join(b, ["job_id", "angle", "idx"], "full").groupBy("job_id", "angle").agg(F.count("v").alias("nv"), F.count("s").alias("ns"), F.bool_or(F.coalesce("e1", F.lit(False)) | F.coalesce("e2", F.lit(False))).alias("empty"), F.bool_and(F.coalesce(F.col("v") == F.col("s"), F.lit(False))).alias("same"))
    state = F.when((F.col("nv") == 0) | (F.col("ns") == 0), "absent").when(F.col("nv") != F.col("ns"), "count_mismatch").when(F.col("empty"), "empty").when(F.col("same"), "ok").otherwise("mismatch")
    return g.select("job_id", "angle", state.alias("state"))


def pregrade_plan(spans: DataFrame, profiles: DataFrame, declared: DataFrame) -> DataFrame:
    """What each source of a job needs: the A source is the reference, others are judged by their profile over used spans.

    spans(job_id, angle, source), profiles(source, p10, p90, ...), declared(job_id, source): sources with a grade of their own keep it.
    Result: job_id, source, plan (reference, declared, normal, underexposed, overexposed, or unmeasured).
    """
    used = spans.select("job_id", "angle", "source").distinct()
    rows = used.join(profiles.select("source", "p10", "p90"), "source", "left")
    ref = rows.filter("angle = 'A'").groupBy("job_id").agg(F.min_by("p10", "source").alias("r10"), F.min_by("p90", "source").alias("r90"))
    own = declared.select("job_id", "source").distinct().withColumn("_own", F.lit(True))
    judged = rows.join(ref, "job_id", "left").join(own, ["job_id", "source"], "left")
    d10, d90 = F.col("p10") / F.greatest("r10", F.lit(1e-4)), F.try_divide("p90", "r90")
    label = F.when(F.col("r90") <= 0, "normal").when((d90 < 0.75) | (d10 < 0.75), "underexposed").when((d10 > 1.6) | (d90 > 1.5), "overexposed").otherwise("normal")
    plan = F.when(F.col("angle") == "A", "reference").when(F.col("_own"), "declared").when(F.col("p10").isNull() | F.col("r10").isNull(), "unmeasured").otherwise(label)
    return judged.select("job_id", "angle", "source", plan.alias("plan"))


def apply_curve(values: DataFrame, curves: DataFrame) -> DataFrame:
    """y of values (match_id, at, ch, v in 0..1) on the piecewise linear curve of their time (match_id, at, ch, i, x, y); held outside its points."""
    w = Window.partitionBy("match_id", "at", "ch").orderBy("x", "i")
    seg = curves.withColumns({"x1": F.lead("x").over(w), "y1": F.lead("y").over(w), "first": F.row_number().over(w) == 1})
    met = values.join(seg, ["match_id", "at", "ch"])
    inside = (F.col("v") >= F.col("x")) & (F.col("x1").isNull() | (F.col("v") < F.col("x1"))) | F.col("first") & (F.col("v") < F.col("x"))
    u = (F.col("v") - F.col("x")) / (F.col("x1") - F.col("x"))
    y = F.when(F.col("x1").isNull() | (F.col("v") < F.col("x")), F.col("y")).otherwise(F.col("y") + (F.col("y1") - F.col("y")) * u)
    return met.filter(inside).select(*values.columns, y.alias("y"))


def transform_steps(levels: DataFrame, points: DataFrame, joins: DataFrame, half: float, limit: float) -> DataFrame:
    """The same levels (match_id, ch, v) through the curve just before and just after each join (match_id, j): greatest change over channels, and whether it is within the limit."""
    times = joins.select("match_id", "j", F.explode(F.array(F.struct(F.lit("before").alias("side"), (F.col("j") - half).alias("at")), F.struct(F.lit("after").alias("side"), (F.col("j") + half).alias("at")))).alias("s")).select("match_id", "j", "s.*")
    curves = curve_at(points, times.select("match_id", "at").distinct())
    shown = apply_curve(times.join(levels, "match_id").select("match_id", "at", "ch", "j", "side", "v"), curves)
    g = shown.groupBy("match_id", "j", "ch", "v").agg(F.max(F.when(F.col("side") == "before", F.col("y"))).alias("b"), F.max(F.when(F.col("side") == "after", F.col("y"))).alias("a"))
    return g.groupBy("match_id", "j").agg(F.round(F.max(F.abs(F.col("a") - F.col("b"))), 6).alias("step")).withColumn("pass", F.coalesce(F.col("step") <= limit, F.lit(False)))
