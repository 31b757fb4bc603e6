"""Delivered-output QC."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.blocks import islands, nearest, overlap


def detect_cuts(diffs: DataFrame, fixed: float | None = None, mads: float = 8.0) -> DataFrame:
    """View changes in frame differences (clip_id, frame_no, d): above `fixed`, or above median + max(mads * MAD, 0.01); bursts of neighbours give their greatest (first of equals)."""
    if fixed is None:
        med = diffs.groupBy("clip_id").agg(F.percentile("d", 0.5).alias("med"))
        dev = diffs.join(med, "clip_id")
        thr = dev.groupBy("clip_id").agg((F.first("med") + F.greatest(mads * F.percentile(F.abs(F.col("d") - F.col("med")), 0.5), F.lit(0.01))).alias("thr"))
        above = diffs.join(thr, "clip_id")
    else:
        above = diffs.withColumn("thr", F.lit(fixed))
    w = Window.partitionBy("clip_id").orderBy("frame_no")
    hits = above.filter(F.col("d") > F.col("thr"))
    bursts = islands(hits, ["clip_id"], ["frame_no"], F.col("frame_no") - F.lag("frame_no").over(w) > 2, "burst")
    return bursts.groupBy("clip_id", "burst").agg(F.min_by("frame_no", F.struct(-F.col("d"), "frame_no")).alias("frame_no"), F.max("d").alias("d")).drop("burst")


def classify_spikes(spikes: DataFrame, least: float = 0.5) -> DataFrame:
    """motion or cut: two frames that still correlate show motion, and so do frames that both match one source; null evidence decides nothing.

    spikes(clip_id, frame_no, corr, a_before, a_after, b_before, b_after): correlations of the sides with A and B references.
    """
    same = lambda x: F.coalesce((F.col(f"{x}_before") >= least) & (F.col(f"{x}_after") >= least), F.lit(False))
    return spikes.withColumn("kind", F.when(F.coalesce(F.col("corr") >= least, F.lit(False)) | same("a") | same("b"), "motion").otherwise("cut"))


def attribute_cuts(detected: DataFrame, planned: DataFrame, tolerance: float = 0.3) -> DataFrame:
    """Each detected change (job_id, t) with the nearest planned cut (job_id, at, cut_id) within tolerance, else unplanned; and planned cuts that none was near to, as missing."""
    n = nearest(detected, planned, "job_id", "t", "at", ["cut_id"])
    near = F.coalesce(F.abs(F.col("t") - F.col("near_at")) <= tolerance, F.lit(False))
    found = n.select("job_id", "t", F.when(near, F.col("near_cut_id")).alias("cut_id"), F.when(near, "planned").otherwise("unplanned").alias("state"), F.when(near, F.abs(F.col("t") - F.col("near_at"))).alias("error"))
    missing = planned.join(found.filter("cut_id is not null").select("job_id", "cut_id").distinct(), ["job_id", "cut_id"], "left_anti").select("job_id", F.col("at").alias("t"), "cut_id", F.lit("missing").alias("state"), F.lit(None).cast("double").alias("error"))
    return found.unionByName(missing)


def segment_angle(segs: DataFrame, least: float = 0.5) -> DataFrame:
    """ok, wrong_angle or unavailable per segment (angle, corr_a, corr_b): the angle's own reference must correlate best; without B's reference, B must at least not look like A."""
    a, b = F.col("corr_a"), F.col("corr_b")
    right = F.when(F.col("angle") == "A", (a >= least) & (b.isNull() | (a >= b))).when(b.isNull(), F.when(a.isNotNull(), a < least)).otherwise((b >= least) & (a.isNull() | (b >= a)))
    return segs.withColumn("state", F.when(right.isNull(), "unavailable").when(right, "ok").otherwise("wrong_angle"))


def insert_lengths(segs: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """B segments whose programme and source lengths differ by the tolerance or more."""
    d = F.abs((F.col("proof_out") - F.col("proof_in")) - (F.col("source_out") - F.col("source_in")))
    return segs.filter(F.col("angle") == "B").withColumn("diff", d).filter(F.col("diff") >= tolerance)


def boundary_check(bounds: DataFrame, detected: DataFrame, planned: DataFrame, near: float = 1.0, tolerance: float = 0.3) -> DataFrame:
    """bound_id, visible: a detected change (job_id, t) within `near` of a processing boundary (job_id, bound_id, b) that no planned cut (job_id, at) explains."""
    bound = bounds.withColumns({"_lo": F.col("b") - near, "_hi": F.col("b") + near})
    met = overlap(bound, detected.withColumn("t2", F.col("t")), "job_id", ("_lo", "_hi"), ("t", "t2"), 16.0, closed=True)
    odd = nearest(met.select("job_id", "bound_id", "t"), planned, "job_id", "t", "at").filter("near_at is null or abs(near_at - t) > %s" % tolerance)
    seen = odd.groupBy("job_id", "bound_id").agg(F.count("*").alias("changes"))
    return bounds.select("job_id", "bound_id").join(seen, ["job_id", "bound_id"], "left").select("job_id", "bound_id", F.coalesce("changes", F.lit(0)).alias("changes")).withColumn("visible", F.col("changes") > 0)


def audio_lag(a: DataFrame, b: DataFrame, max_lag: int, least: int = 20) -> DataFrame:
    """Per pair: the lag with the greatest correlation of two series (pair, n, x), over at least `least` common samples; the smallest lag of equals."""
    x = a.withColumn("lag", F.explode(F.sequence(F.lit(-max_lag), F.lit(max_lag)))).select("pair", "lag", (F.col("n") + F.col("lag")).alias("m"), F.col("x").alias("xa"))
    c = x.join(b.select("pair", F.col("n").alias("m"), F.col("x").alias("xb")), ["pair", "m"]).groupBy("pair", "lag").agg(F.round(F.corr("xa", "xb"), 6).alias("c"), F.count("*").alias("k")).filter(F.col("k") >= least)
    return c.filter("c is not null").groupBy("pair").agg(F.min_by("lag", F.struct(-F.col("c"), F.abs("lag"), "lag")).alias("lag"), F.max("c").alias("corr"))


def temporal_steps(stats: DataFrame, step: float, clipped: float, black: float) -> DataFrame:
    """Across joins (before and after frames' luma, clipped_pct, black_pct): luma step, new clipping, black crush, and pass."""
    luma, c, b = F.abs(F.col("luma_after") - F.col("luma_before")), F.col("clip_after") - F.col("clip_before"), F.col("black_after") - F.col("black_before")
    rows = stats.withColumns({"step": luma, "new_clip": c, "crush": b})
    return rows.withColumn("pass", (F.col("step") <= step) & (F.col("new_clip") <= clipped) & (F.col("crush") <= black))


def placement(diff: DataFrame, rect: tuple[int, int, int, int]) -> DataFrame:
    """Per frame of a difference image (frame_id, y, x, v): cutoff = max(3 * p99.5 outside the rectangle, 40), bounding box of what exceeds it, how much spills out.

    rect: y0, x0, y1, x1, ends exclusive.
    """
    y0, x0, y1, x1 = rect
    inside = F.col("y").between(y0, y1 - 1) & F.col("x").between(x0, x1 - 1)
    cut = diff.groupBy("frame_id").agg(F.greatest(3 * F.percentile(F.when(~inside, F.col("v")), 0.995), F.lit(40.0)).alias("cutoff"))
    on = diff.join(cut, "frame_id").filter(F.col("v") > F.col("cutoff"))
    g = on.groupBy("frame_id").agg(F.min("y").alias("top"), F.max("y").alias("bottom"), F.min("x").alias("left"), F.max("x").alias("right"), F.count("*").alias("n"), F.count_if(~inside).alias("spill"))
    return cut.join(g, "frame_id", "left").withColumn("contained", F.coalesce(F.col("spill") == 0, F.lit(False)))


def phase_match(regions: DataFrame, templates: DataFrame, loop: int, fps: float) -> DataFrame:
    """Each region (region_id, pts, px) with the template frame (k, tpx) of least mean error (first of equals), against floor(pts * fps) mod loop; circular distance at most 1 passes.

    Templates are one loop of an overlay, a few dozen frames, and go to every task.
    """
    err = F.aggregate(F.zip_with("px", "tpx", lambda a, b: F.abs(a - b).cast("double")), F.lit(0.0), lambda s, x: s + x)
    best = regions.crossJoin(F.broadcast(templates)).withColumn("err", err).groupBy("region_id").agg(F.first("pts").alias("pts"), F.min_by("k", F.struct("err", "k")).alias("k"))
    want = F.pmod(F.floor(F.col("pts") * fps), F.lit(loop)).cast("int")
    d = F.pmod(F.col("k") - want, F.lit(loop))
    return best.select("region_id", "k", want.alias("expected"), F.least(d, loop - d).alias("delta")).withColumn("pass", F.col("delta") <= 1)


def loop_and_alpha(px: DataFrame) -> DataFrame:
    """Mean absolute differences by alpha band (clip_id, band, now, after_loop, after_half): the overlay loops if a full loop differs by less than half of what half a loop does."""
    d = lambda c: F.avg(F.abs(F.col("now") - F.col(c)))
    g = px.groupBy("clip_id", "band").agg(d("after_loop").alias("d_loop"), d("after_half").alias("d_half"))
    return g.withColumn("loops", F.col("d_loop") < F.col("d_half") / 2)


def sample_plan(segs: DataFrame, fractions: tuple[float, ...], offset: float, cap: int) -> DataFrame:
    """Instants to look at per job: each cut ± offset and fixed fractions of the programme, each once, thinned evenly to at most `cap`.

    segs(job_id, proof_in, proof_out): one job's programme is a few thousand cuts.
    """
    total = segs.groupBy("job_id").agg(F.max("proof_out").alias("end"))
    cuts = segs.filter("proof_in > 0").select("job_id", F.explode(F.array(F.col("proof_in") - offset, F.col("proof_in") + offset)).alias("t"))
    fixed = total.select("job_id", F.explode(F.array(*(F.col("end") * f for f in fractions))).alias("t"))
    every = cuts.unionByName(fixed).withColumn("t", F.round("t", 3)).join(total, "job_id").filter("t >= 0 and t <= end").select("job_id", "t").distinct()
    w = Window.partitionBy("job_id")
    rows = every.withColumns({"i": F.row_number().over(w.orderBy("t")) - 1, "n": F.count("*").over(w)})
    stride = F.ceil(F.col("n") / cap)
    return rows.filter(F.pmod(F.col("i"), stride) == 0).select("job_id", "t")


def delivery_check(probes: DataFrame, expected: DataFrame) -> DataFrame:
    """subject, key, pass, why for expectations (subject, key, want, tolerance) against probes (subject, key, got): numbers within the tolerance, else equal texts; absent evidence fails."""
    both = expected.join(probes, ["subject", "key"], "left")
    want, got = F.col("want").try_cast("double"), F.col("got").try_cast("double")
    same = F.when(F.col("tolerance").isNotNull() & want.isNotNull(), F.coalesce(F.abs(got - want) <= F.col("tolerance"), F.lit(False))).otherwise(F.col("got") == F.col("want"))
    return both.select("subject", "key", F.coalesce(same, F.lit(False)).alias("pass"), F.when(F.col("got").isNull(), "absent").when(~F.coalesce(same, F.lit(False)), "differs").otherwise("").alias("why"))


def verdict(checks: DataFrame, subjects: DataFrame) -> DataFrame:
    """PASS, FAIL or, without any check, ERROR per subject, with the failed checks in order. checks(subject, name, pass)."""
    g = checks.groupBy("subject").agg(F.bool_and("pass").alias("ok"), F.array_join(F.array_sort(F.collect_set(F.when(~F.col("pass"), F.col("name")))), ",").alias("failed"))
    return subjects.select("subject").distinct().join(g, "subject", "left").select("subject", F.when(F.col("ok").isNull(), "ERROR").when(F.col("ok"), "PASS").otherwise("FAIL").alias("verdict"), F.coalesce("failed", F.lit("")).alias("failed"))
