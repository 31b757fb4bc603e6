"""Activity runs and episodes over series (clip_id, n from 0, sm, ...): one sample is 1/fps seconds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.blocks import apart, greedy, islands, overlap


def local_peaks(series: DataFrame, half: int = 2, value: str = "sm") -> DataFrame:
    """Interior samples that are the maximum of their neighbourhood and at or above the clip's median."""
    w = Window.partitionBy("clip_id")
    rows = series.withColumns({"_max": F.max(value).over(w.orderBy("n").rowsBetween(-half, half)), "_last": F.max("n").over(w)})
    med = series.groupBy("clip_id").agg(F.percentile(value, 0.5).alias("med"))
    rows = rows.filter((F.col(value) == F.col("_max")) & (F.col("n") >= half) & (F.col("n") < F.col("_last") + 1 - half)).join(med, "clip_id")
    return rows.filter(F.col(value) >= F.col("med")).select("clip_id", "n", F.col(value).alias("pk"), "med", "_last")


def expand_runs(peaks: DataFrame, series: DataFrame, frac: float, cap: int, value: str = "sm") -> DataFrame:
    """lo, hi: the samples around each peak above max(frac * peak, median); a run longer than cap is cut to cap about the peak.

    Only samples within cap of the peak are looked at, so the join stays linear in the series.
    """
    p = peaks.withColumns({"floor": F.greatest(F.col("pk") * frac, "med"), "_a": F.col("n") - cap - 1, "_b": F.col("n") + cap + 1})
    s = series.select("clip_id", F.col("n").alias("m"), F.col(value).alias("x")).withColumn("m2", F.col("m"))
    near = overlap(p, s, "clip_id", ("_a", "_b"), ("m", "m2"), 64.0, closed=True)
    fails = F.col("x") <= F.col("floor")
    g = near.groupBy("clip_id", "n", "pk", "med", "floor", "_last").agg(F.max(F.when(fails & (F.col("m") < F.col("n")), F.col("m"))).alias("l"), F.min(F.when(fails & (F.col("m") > F.col("n")), F.col("m"))).alias("r"))
    lo = F.coalesce(F.col("l") + 1, F.greatest(F.lit(0), F.col("n") - cap - 1))
    hi = F.coalesce(F.col("r") - 1, F.least(F.col("_last"), F.col("n") + cap + 1))
    g = g.withColumns({"lo": lo, "hi": hi}).withColumn("capped", F.col("hi") + 1 - F.col("lo") > cap)
    half = int(round(cap / 2))
    cut = {"lo": F.when(F.col("capped"), F.greatest(F.lit(0), F.col("n") - half)).otherwise(F.col("lo")), "hi": F.when(F.col("capped"), F.least(F.col("_last"), F.col("n") + half)).otherwise(F.col("hi"))}
    return g.withColumns(cut).select("clip_id", "n", "pk", "floor", "lo", "hi", "capped")


def nms_runs(runs: DataFrame, min_sep: float, min_len: float) -> DataFrame:
    """Strongest first; a run goes if it overlaps an accepted one, begins nearer than min_sep to its onset, or is too short.

    Runs are folded by parts of a clip that no overlap and no distance joins."""
    long = runs.filter(F.col("hi") + 1 - F.col("lo") >= min_len)
    clear = lambda kept, x: ~F.exists(kept, lambda k: ((x["lo"] < k["hi"]) & (x["hi"] > k["lo"])) | (F.abs(x["lo"] - k["lo"]) < min_sep))
    parts = apart(long, ["clip_id"], F.col("lo"), F.greatest("hi", F.col("lo") + min_sep), ["n"])
    return greedy(parts, ["clip_id", "_part"], [("pk", True), ("n", False)], ["n", "pk", "floor", "lo", "hi", "capped"], clear).drop("_part")


def describe_runs(runs: DataFrame, series: DataFrame, still: float = 0.35) -> DataFrame:
    """mass, strength_pct, mean and least luma, frozen share; run ids by onset. series(clip_id, n, sm, luma, glob)."""
    s = series.select("clip_id", F.col("n").alias("m"), "sm", "luma", "glob").withColumn("m2", F.col("m"))
    inside = overlap(runs, s, "clip_id", ("lo", "hi"), ("m", "m2"), 64.0, closed=True)
    g = inside.groupBy("clip_id", "n", "pk", "lo", "hi").agg(F.sum(F.col("sm") - F.col("floor")).alias("mass"), F.avg("luma").alias("luma_mean"), F.min("luma").alias("luma_min"), (F.count_if(F.col("glob") < still) / F.count("*")).alias("frozen_frac"))
    below = runs.select("clip_id", "n", "pk").join(series.select("clip_id", F.col("sm").alias("x")), "clip_id").groupBy("clip_id", "n").agg((100 * F.count_if(F.col("x") < F.col("pk")) / F.count("*")).alias("strength_pct"))
    ranked = g.join(below, ["clip_id", "n"]).withColumn("k", F.row_number().over(Window.partitionBy("clip_id").orderBy("lo", "n")))
    return ranked.withColumn("run_id", F.format_string("run_%02d", "k")).drop("k")


def mad_episodes(series: DataFrame, k: float = 3.0, gap: int = 2, min_len: int = 2, sep: float = 8.0, top: int = 12) -> DataFrame:
    """Episodes above median + k * 1.4826 * MAD, gaps merged, by excess mass, peaks apart, the top ones."""
    med = series.groupBy("clip_id").agg(F.percentile("sm", 0.5).alias("med"))
    dev = series.join(med, "clip_id").withColumn("dev", F.abs(F.col("sm") - F.col("med")))
    thr = dev.groupBy("clip_id").agg((F.first("med") + k * (F.percentile("dev", 0.5) * 1.4826)).alias("thr"))
    above = series.join(thr, "clip_id").filter(F.col("sm") > F.col("thr"))
    w = Window.partitionBy("clip_id").orderBy("n")
    merged = islands(above, ["clip_id"], ["n"], F.col("n") - F.lag("n").over(w) > gap, "ep")
    bounds = merged.groupBy("clip_id", "ep").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.first("thr").alias("thr"))
    s = series.select("clip_id", F.col("n").alias("m"), "sm").withColumn("m2", F.col("m"))
    inside = overlap(bounds.filter(F.col("hi") - F.col("lo") + 1 >= min_len), s, "clip_id", ("lo", "hi"), ("m", "m2"), 64.0, closed=True)
    eps = inside.groupBy("clip_id", "lo", "hi").agg(F.round(F.sum(F.col("sm") - F.col("thr")), 6).alias("mass"), F.min_by("m", F.struct(-F.col("sm"), "m")).alias("peak"))
    return greedy(eps, ["clip_id"], [("mass", True), ("lo", False)], ["lo", "hi", "mass", "peak"], lambda kept, x: F.forall(kept, lambda e: F.abs(e["peak"] - x["peak"]) >= sep), top)


def peak_episodes(series: DataFrame, frac: float = 0.6, sep: float = 15.0, top: int = 12, cap: int = 64) -> DataFrame:
    """Peaks first: strongest peaks sep apart, expanded at frac of the peak, ranked by mass above the floor."""
    peaks = local_peaks(series)
    kept = greedy(peaks, ["clip_id"], [("pk", True), ("n", False)], ["n", "pk", "med", "_last"], lambda kept, x: F.forall(kept, lambda e: F.abs(e["n"] - x["n"]) >= sep), top)
    runs = expand_runs(kept, series, frac, cap)
    s = series.select("clip_id", F.col("n").alias("m"), "sm").withColumn("m2", F.col("m"))
    inside = overlap(runs, s, "clip_id", ("lo", "hi"), ("m", "m2"), 64.0, closed=True)
    g = inside.groupBy("clip_id", "n", "lo", "hi").agg(F.round(F.sum(F.col("sm") - F.col("floor")), 6).alias("mass"))
    return g.withColumn("rank", F.row_number().over(Window.partitionBy("clip_id").orderBy(F.desc("mass"), "n")))


def consensus(episodes: DataFrame, gap: float = 6.0, votes: int = 2) -> DataFrame:
    """Clusters of episodes (clip_id, metric, t0, t1, peak): a peak more than gap after the greatest before begins a new one.

    Clusters with at least `votes` different metrics stay, with medians of t0, t1 and peak.
    """
    w = Window.partitionBy("clip_id").orderBy("peak", "metric", "t0")
    before = F.max("peak").over(w.rowsBetween(Window.unboundedPreceding, -1))
    c = islands(episodes, ["clip_id"], ["peak", "metric", "t0"], F.col("peak") > before + gap, "cluster")
    g = c.groupBy("clip_id", "cluster").agg(F.count_distinct("metric").alias("votes"), F.count("*").alias("n"), *(F.percentile(x, 0.5).alias(x) for x in ("t0", "t1", "peak")))
    return g.filter(F.col("votes") >= votes)
