"""Frame and audio signal features, from tables of decoded frames and samples.

Frames are rows with a pixel array, so spatial measures need no shuffle; only the previous frame comes by a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.blocks import greedy, islands, nearest, overlap


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double"))


def mean(a: Column) -> Column:
    return _sum(a) / F.size(a)


def frame_histogram(frames: DataFrame, bins: int = 16) -> DataFrame:
    """hist: shares of grey values in `bins` equal bins of [0, 256)."""
    width = 256 // bins
    share = lambda b: F.size(F.filter("px", lambda v: F.floor(v / width) == b)) / F.size("px")
    return frames.withColumn("hist", F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), share))


def frame_quality(frames: DataFrame, h: int = 8, w: int = 8) -> DataFrame:
    """brightness, the mean, and sharpness, the population variance of the 4-neighbour Laplacian with replicated edges."""

    def laplacian(v: Column, i: Column) -> Column:
        r, c = F.floor(i / w).cast("int"), (i % w).cast("int")
        at = lambda y, x: F.col("px")[(F.greatest(F.lit(0), F.least(F.lit(h - 1), y)) * w + F.greatest(F.lit(0), F.least(F.lit(w - 1), x))).cast("int")]
        return (at(r - 1, c) + at(r + 1, c) + at(r, c - 1) + at(r, c + 1) - 4 * v).cast("double")

    rows = frames.withColumn("_lap", F.transform("px", laplacian)).withColumn("_m", mean(F.col("_lap")))
    return rows.withColumns({"brightness": mean(F.col("px")), "sharpness": mean(F.transform("_lap", lambda x: (x - F.col("_m")) * (x - F.col("_m"))))}).drop("_lap", "_m")


def by_clip() -> Window:
    return Window.partitionBy("clip_id").orderBy("frame_no")


def frame_motion(frames: DataFrame) -> DataFrame:
    """motion: mean absolute difference to the clip's previous frame over 255; 0 for the first or where the shape changed."""
    prev = F.lag("px").over(by_clip())
    rows = frames.withColumn("_prev", prev)
    diff = mean(F.zip_with("px", "_prev", lambda a, b: F.abs(a - b))) / 255
    return rows.withColumn("motion", F.when(F.size("px") == F.size("_prev"), diff).otherwise(F.lit(0.0))).drop("_prev")


def intersection(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: F.least(x, y)))


def hist_novelty(samples: DataFrame) -> DataFrame:
    """novelty: 1 - intersection with the last non-null histogram before; null for the first and for null histograms."""
    prev = F.last("hist", ignorenulls=True).over(by_clip().rowsBetween(Window.unboundedPreceding, -1))
    return samples.withColumn("_prev", prev).withColumn("novelty", 1 - intersection(F.col("hist"), F.col("_prev"))).drop("_prev")


def clamp01(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def obstruction(samples: DataFrame, black: float = 24.0, white: float = 235.0, detail_floor: float = 40.0) -> DataFrame:
    """black_sev, white_sev, detail and obstruction: darkness or blow-out counts only where the frame is flat too."""
    detail = clamp01(F.col("sharpness") / detail_floor)
    b = clamp01((black - F.col("brightness")) / black) * (1 - detail)
    w = clamp01((F.col("brightness") - white) / (255 - white)) * (1 - detail)
    return samples.withColumns({"detail": detail, "black_sev": b, "white_sev": w, "obstruction": F.greatest(b, w)})


def frozen_flag(samples: DataFrame, threshold: float, n: int = 3) -> DataFrame:
    """frozen: inside a run of n or more samples whose motion is below the threshold; null motion ends a run."""
    still = F.coalesce(F.col("motion") < threshold, F.lit(False))
    rows = samples.withColumn("_still", still)
    rows = islands(rows, ["clip_id"], ["t"], F.lag("_still").over(Window.partitionBy("clip_id").orderBy("t")) != F.col("_still"))
    size = F.count("*").over(Window.partitionBy("clip_id", "island"))
    return rows.withColumn("frozen", F.col("_still") & (size >= n)).drop("_still", "island")


def mark_used(samples: DataFrame, spans: DataFrame) -> DataFrame:
    """used: the sample's time lies in a span (clip_id, a, b), ends included."""
    s = samples.select("clip_id", "t").withColumn("t2", F.col("t"))
    hit = overlap(s, spans, "clip_id", ("t", "t2"), ("a", "b"), 16.0, closed=True).select("clip_id", "t").distinct().withColumn("used", F.lit(True))
    return samples.join(hit, ["clip_id", "t"], "left").withColumn("used", F.coalesce("used", F.lit(False)))


def signal_summary(samples: DataFrame, flag: float = 0.5) -> DataFrame:
    """Per clip: counts, mean/p10/p50/p90/max of motion, brightness and sharpness, and shares of obstructed, frozen, clean and used samples."""
    stats = [f(c).alias(f"{c}_{n}") for c in ("motion", "brightness", "sharpness") for n, f in (("mean", F.avg), ("p10", lambda c: F.percentile(c, 0.1)), ("p50", lambda c: F.percentile(c, 0.5)), ("p90", lambda c: F.percentile(c, 0.9)), ("max", F.max))]
    share = lambda c: F.count_if(c) / F.count("*")
    bad = F.col("obstruction") >= flag
    return samples.groupBy("clip_id").agg(F.count("*").alias("n"), *stats, share(bad).alias("obstructed"), share(F.col("frozen")).alias("frozen_frac"), share(~bad & ~F.col("frozen")).alias("clean_frac"), share(F.col("used")).alias("used_frac"))


def beat_alignment(samples: DataFrame, beats: DataFrame) -> DataFrame:
    """Per clip: mean and p90 distance of samples to the nearest beat, share within 50 ms, beats inside the samples' span."""
    near = nearest(samples.select("clip_id", "t"), beats.select("clip_id", F.col("t").alias("beat")), "clip_id", "t", "beat").withColumn("d", F.abs(F.col("t") - F.col("near_beat")))
    g = near.groupBy("clip_id").agg(F.avg("d").alias("mean_dist"), F.percentile("d", 0.9).alias("p90_dist"), (F.count_if(F.col("d") <= 0.05) / F.count("d")).alias("aligned"), F.min("t").alias("lo"), F.max("t").alias("hi"))
    inside = beats.join(g.select("clip_id", "lo", "hi"), "clip_id").filter("t >= lo and t <= hi").groupBy("clip_id").agg(F.count("*").alias("beats_in_span"))
    return g.drop("lo", "hi").join(inside, "clip_id", "left").withColumn("beats_in_span", F.coalesce("beats_in_span", F.lit(0)))


def global_gain(frames: DataFrame, target: float = 60.0) -> DataFrame:
    """Per clip: the gain that brings the 99.5th percentile of all its pixels to the target."""
    p = frames.select("clip_id", F.explode("px").alias("v")).groupBy("clip_id").agg(F.percentile("v", 0.995).alias("p995"))
    return p.select("clip_id", "p995", F.try_divide(F.lit(target), F.col("p995")).alias("gain"))


def cell_activity(frames: DataFrame, h: int = 8, w: int = 8, cy: int = 4, cx: int = 4) -> DataFrame:
    """Between a frame and the next: mean absolute difference per cell; glob, loc, first cell of the maximum, activ, artic, luma of the earlier frame, conc."""
    ch, cw = h // cy, w // cx
    rows = frames.withColumn("_next", F.lead("px").over(by_clip())).filter(F.col("_next").isNotNull())
    rows = rows.withColumn("_d", F.zip_with("px", "_next", lambda a, b: F.abs(a - b).cast("double")))

    def cell(k: Column) -> Column:
        r0, c0 = F.floor(k / cx) * ch, (k % cx) * cw
        total = F.aggregate(F.sequence(F.lit(0), F.lit(ch * cw - 1)), F.lit(0.0), lambda s, i: s + F.col("_d")[((r0 + F.floor(i / cw)) * w + c0 + i % cw).cast("int")])
        return total / (ch * cw)

    rows = rows.withColumn("_cells", F.transform(F.sequence(F.lit(0), F.lit(cy * cx - 1)), cell))
    rows = rows.withColumns({"glob": mean(F.col("_cells")), "loc": F.array_max("_cells"), "luma": mean(F.col("px"))})
    rows = rows.withColumns({"cell": F.array_position("_cells", F.col("loc")).cast("int") - 1, "activ": _sum(F.transform("_cells", lambda c: F.greatest(c - F.col("glob"), F.lit(0.0))))})
    quiet = rows.groupBy("clip_id").agg((2.5 * F.percentile("glob", 0.1)).alias("_floor"))
    rows = rows.join(quiet, "clip_id")
    artic = _sum(F.transform("_cells", lambda c: F.greatest(c - F.col("_floor"), F.lit(0.0))))
    return rows.select("clip_id", "frame_no", "glob", "loc", "cell", "activ", artic.alias("artic"), "luma", (F.col("loc") / F.greatest("glob", F.lit(1e-6))).alias("conc"))


def smooth_same(series: DataFrame, value: str, order: str, k: int = 5, name: str = "sm") -> DataFrame:
    """Moving average of k (odd) samples, zero padded at the ends."""
    half = k // 2
    return series.withColumn(name, F.sum(value).over(Window.partitionBy("clip_id").orderBy(order).rowsBetween(-half, half)) / k)


def rms_per_second(audio: DataFrame) -> DataFrame:
    """clip_id, sec, rms over samples (clip_id, t, v); seconds without a sample up to the last are 0."""
    g = audio.groupBy("clip_id", F.floor("t").cast("bigint").alias("sec")).agg(F.sqrt(F.avg(F.col("v") * F.col("v"))).alias("rms"))
    grid = audio.groupBy("clip_id").agg(F.floor(F.max("t")).cast("bigint").alias("last")).select("clip_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last"))).alias("sec"))
    return grid.join(g, ["clip_id", "sec"], "left").select("clip_id", "sec", F.coalesce("rms", F.lit(0.0)).alias("rms"))


def action_profile(rms: DataFrame, segment: int = 10, offset: float = 0.0) -> DataFrame:
    """Segments of `segment` seconds: mean of rms over its own p95, clipped to 1; the last may be shorter."""
    p = rms.groupBy("clip_id").agg(F.percentile("rms", 0.95).alias("p95"), (F.max("sec") + 1).alias("dur"))
    norm = rms.join(p, "clip_id").withColumn("x", clamp01(F.when(F.col("p95") > 1e-6, F.col("rms") / F.col("p95")).otherwise(F.col("rms"))))
    g = norm.groupBy("clip_id", F.floor(F.col("sec") / segment).alias("seg")).agg(F.avg("x").alias("score"), F.first("dur").alias("dur"))
    return g.select("clip_id", (F.col("seg") * segment + offset).alias("start_s"), (F.least((F.col("seg") + 1) * segment, "dur") + offset).alias("end_s"), "score")


def keyframe_score(samples: DataFrame) -> DataFrame:
    """0.5 sharpness/400 + 0.25 brightness about 118 + 0.25 motion/12 (0.5 where there is no motion)."""
    bright = 1 - F.least(F.lit(1.0), F.abs(F.col("brightness") - 118) / 118)
    motion = F.coalesce(F.least(F.lit(1.0), F.col("motion") / 12), F.lit(0.5))
    return samples.withColumn("score", 0.5 * F.least(F.lit(1.0), F.col("sharpness") / 400) + 0.25 * bright + 0.25 * motion)


def pick_keyframes(scored: DataFrame, n: int, gap: float) -> DataFrame:
    """The n best samples of each clip, no two nearer than gap."""
    return greedy(scored, ["clip_id"], [("score", True), ("t", False)], ["t", "score"], lambda kept, x: F.forall(kept, lambda k: F.abs(k["t"] - x["t"]) >= gap), n)


def sample_times(spans: DataFrame, count: int) -> DataFrame:
    """`count` evenly spaced instants in the middle of equal parts of each span (key columns, a, b)."""
    keys = [c for c in spans.columns if c not in ("a", "b")]
    i = F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("i")
    return spans.select(*keys, "a", "b", i).select(*keys, "i", (F.col("a") + (F.col("b") - F.col("a")) * (F.col("i") + 0.5) / count).alias("t"))


def sample_every(spans: DataFrame, every: float, most: int) -> DataFrame:
    """Instants a, a + every, ... within each span, at most `most`."""
    keys = [c for c in spans.columns if c not in ("a", "b")]
    n = F.least(F.floor((F.col("b") - F.col("a")) / every).cast("int"), F.lit(most - 1))
    return spans.filter("b >= a").select(*keys, "a", F.explode(F.sequence(F.lit(0), n)).alias("i")).select(*keys, "i", (F.col("a") + F.col("i") * every).alias("t"))


def kick_phase(audio: DataFrame, beats: DataFrame, window: float = 0.06, per_bar: int = 4, lift: float = 1.05) -> DataFrame:
    """Per clip: the beat phase with the most energy just after its beats (first of equals), its lift over all beats, and whether it counts."""
    b = beats.select("clip_id", "i", F.col("t").alias("b0"), (F.col("t") + window).alias("b1"))
    a = audio.withColumn("t2", F.col("t"))
    hits = overlap(b, a, "clip_id", ("b0", "b1"), ("t", "t2"), 4.0, closed=True).filter("t < b1")
    energy = hits.groupBy("clip_id", "i").agg(F.sqrt(F.avg(F.col("v") * F.col("v"))).alias("e"))
    each = beats.select("clip_id", "i").join(energy, ["clip_id", "i"], "left").withColumn("e", F.coalesce("e", F.lit(0.0)))
    phases = each.groupBy("clip_id", (F.col("i") % per_bar).alias("phase")).agg(F.sum("e").alias("s"), F.count("*").alias("n")).withColumn("m", F.round(F.col("s") / F.col("n"), 9))
    g = phases.groupBy("clip_id").agg(F.min_by("phase", F.struct(-F.col("m"), "phase")).alias("phase"), F.max("m").alias("best"), (F.sum("s") / F.sum("n")).alias("overall"))
    g = g.withColumn("lift", F.round(F.coalesce(F.try_divide("best", "overall"), F.lit(0.0)), 3))
    return g.select("clip_id", "phase", "lift", (F.col("lift") >= lift).alias("detected"))


def rgb_stats(px: DataFrame) -> DataFrame:
    """Per frame: float BT.709 luma, integer BT.601 luma, chroma, channel means, clipped and black percent, and the smallest luma with half and 95 % of pixels at or below."""
    y = F.floor((F.col("r") * 299 + F.col("g") * 587 + F.col("b") * 114) / 1000).cast("int")
    rows = px.withColumns({"y": y, "sat": F.greatest("r", "g", "b") - F.least("r", "g", "b"), "l": 0.2126 * F.col("r") + 0.7152 * F.col("g") + 0.0722 * F.col("b")})
    hist = rows.groupBy("clip_id", "frame_no", "y").agg(F.count("*").alias("c"))
    w = Window.partitionBy("clip_id", "frame_no")
    run = hist.withColumns({"cum": F.sum("c").over(w.orderBy("y")), "n": F.sum("c").over(w)})
    at = lambda p: F.min(F.when(F.col("cum") >= F.col("n") * p, F.col("y")))
    q = run.groupBy("clip_id", "frame_no").agg(at(0.5).alias("y50"), at(0.95).alias("y95"))
    g = rows.groupBy("clip_id", "frame_no").agg(F.avg("l").alias("luma709"), F.avg("y").alias("luma601"), F.avg("sat").alias("chroma"), F.avg("r").alias("r"), F.avg("g").alias("g"), F.avg("b").alias("b"), (100 * F.count_if(F.col("y") >= 235) / F.count("*")).alias("clipped_pct"), (100 * F.count_if(F.col("y") < 16) / F.count("*")).alias("black_pct"))
    return g.join(q, ["clip_id", "frame_no"])


def frame_corr(pairs: DataFrame) -> DataFrame:
    """Pearson correlation of pixel arrays a and b; null where one is missing or constant."""
    rows = pairs.withColumns({"_ma": mean(F.col("a")), "_mb": mean(F.col("b"))})
    dot = lambda x, y, mx, my: _sum(F.zip_with(x, y, lambda p, q: (p - F.col(mx)) * (q - F.col(my))))
    num = dot("a", "b", "_ma", "_mb")
    den = F.sqrt(dot("a", "a", "_ma", "_ma") * dot("b", "b", "_mb", "_mb"))
    return rows.withColumn("corr", F.when(den > 0, num / den)).drop("_ma", "_mb")
