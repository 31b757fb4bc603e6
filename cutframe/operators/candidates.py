"""Candidate evidence and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.blocks import overlap
from .music import first_at_or_after
from .signals import intersection


def overlap_mean(windows: DataFrame, segs: DataFrame, keys: list[str]) -> DataFrame:
    """score: mean of segment scores (job_id, s0, s1, score) weighted by overlap with each window (job_id, keys, w0, w1); null without any."""
    met = overlap(windows, segs, "job_id", ("w0", "w1"), ("s0", "s1"), 16.0)
    span = F.least("w1", "s1") - F.greatest("w0", "s0")
    g = met.groupBy("job_id", *keys).agg(F.try_divide(F.sum(F.col("score") * span), F.sum(span)).alias("score"))
    return windows.select("job_id", *keys).join(g, ["job_id", *keys], "left")


def window_visual(windows: DataFrame, samples: DataFrame, keys: list[str]) -> DataFrame:
    """n, clean share, any flagged, mean sharpness and brightness of the samples in each window, ends widened by 1e-6."""
    s = samples.withColumn("t2", F.col("t"))
    met = overlap(windows, s, "job_id", ("w0", "w1"), ("t", "t2"), 16.0, closed=True, slack=1e-6)
    bad = F.col("flagged") | F.col("frozen")
    g = met.groupBy("job_id", *keys).agg(F.count("*").alias("n"), (F.count_if(~bad) / F.count("*")).alias("clean"), F.bool_or(bad).alias("any_flagged"), F.avg("sharpness").alias("sharpness"), F.avg("brightness").alias("brightness"))
    return windows.select("job_id", *keys).join(g, ["job_id", *keys], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def keyframe_quality(keyframes: DataFrame) -> DataFrame:
    """Per clip: usable (a keyframe with measured, positive sharpness), means, p90 sharpness, and counts by reason."""
    ok = F.col("sharpness") > 0
    return keyframes.groupBy("clip_id").agg(F.coalesce(F.bool_or(ok), F.lit(False)).alias("usable"), F.count("*").alias("n"), F.count_if(F.col("sharpness").isNull()).alias("unmeasured"), F.count_if(F.col("sharpness") == 0).alias("zero"), F.avg(F.when(ok, F.col("sharpness"))).alias("sharpness"), F.avg(F.when(ok, F.col("brightness"))).alias("brightness"), F.percentile(F.when(ok, F.col("sharpness")), 0.9).alias("p90"))


def quality_score(windows: DataFrame, keyframes: DataFrame, samples: DataFrame) -> DataFrame:
    """0.5 min(1, sharpness / p90) + 0.5 brightness adequacy, from keyframes where usable, else samples, else 0; and the source.

    keyframes and samples: (clip_id, sharpness, brightness, p90)
    """
    k = keyframes.select("clip_id", F.col("sharpness").alias("ks"), F.col("brightness").alias("kb"), F.col("p90").alias("kp"))
    s = samples.select("clip_id", F.col("sharpness").alias("ss"), F.col("brightness").alias("sb"), F.col("p90").alias("sp"))
    rows = windows.join(k, "clip_id", "left").join(s, "clip_id", "left")

    def score(sharp: str, bright: str, p90: str):
        sharpness = F.coalesce(F.least(F.lit(1.0), F.try_divide(F.col(sharp), F.col(p90))), F.lit(0.0))
        return 0.5 * sharpness + 0.5 * (1 - F.least(F.lit(1.0), F.abs(F.col(bright) - 128) / 128))

    source = F.when(F.col("ks").isNotNull(), "keyframes").when(F.col("ss").isNotNull(), "samples").otherwise("none")
    value = F.when(F.col("ks").isNotNull(), score("ks", "kb", "kp")).when(F.col("ss").isNotNull(), score("ss", "sb", "sp")).otherwise(F.lit(0.0))
    return rows.select(*windows.columns, source.alias("source"), value.alias("quality"))


def paired_similarity(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Mean histogram intersection of two windows' samples, paired by index (keys, t, hist); n is the shorter length."""
    w = Window.partitionBy(*keys).orderBy("t")
    x = a.withColumn("i", F.row_number().over(w)).select(*keys, "i", F.col("hist").alias("h1"))
    y = b.withColumn("i", F.row_number().over(w)).select(*keys, "i", F.col("hist").alias("h2"))
    return x.join(y, [*keys, "i"]).groupBy(*keys).agg(F.count("*").alias("n"), F.avg(intersection(F.col("h1"), F.col("h2"))).alias("similarity"))


def derive_durations(entries: DataFrame, samples: DataFrame, beats: DataFrame, downbeats: DataFrame, *, least: float, most: float, frac: float = 0.6, needed: int = 4) -> DataFrame:
    """glance, action and hold of each entry (clip_id, entry_id, start, dmax), from the motion samples (clip_id, t, motion) of its window.

    The motion peak (first of equals), the run around it at or above frac of the peak, landmarks on the grid, clamped to
    the policy and forced to rise. Entries with too few samples, or without a landmark, are left out.
    """
    e = entries.withColumn("_end", F.col("start") + F.col("dmax"))
    met = overlap(e, samples.filter("motion is not null").withColumn("t2", F.col("t")), "clip_id", ("start", "_end"), ("t", "t2"), 16.0, closed=True, slack=1e-6)
    keys = ["clip_id", "entry_id"]
    w = Window.partitionBy(*keys)
    rows = met.withColumns({"i": F.row_number().over(w.orderBy("t")), "n": F.count("*").over(w)}).filter(F.col("n") >= needed)
    peak = rows.groupBy(*keys).agg(F.min_by(F.struct("i", "t", "motion"), F.struct(-F.col("motion"), "i")).alias("p"), F.first("n").alias("n"), F.first("start").alias("start"), F.first("dmax").alias("dmax"), (F.max(F.when(F.col("i") == 2, F.col("t"))) - F.min("t")).alias("period"))
    below = rows.join(peak.select(*keys, "p"), keys).filter(F.col("motion") < frac * F.col("p.motion"))
    after = below.filter(F.col("i") > F.col("p.i")).groupBy(*keys).agg(F.min("i").alias("stop"))
    end = peak.join(after, keys, "left").withColumn("hi", F.coalesce(F.col("stop") - 1, F.col("n")))
    run = end.join(rows.select(*keys, F.col("i").alias("hi"), F.col("t").alias("run_hi")), [*keys, "hi"]).withColumns({"peak_t": F.col("p.t"), "run_end": F.col("run_hi") + F.col("period")})
    run = run.select(*keys, "start", "dmax", "n", "peak_t", "run_end", (F.col("hi") == F.col("n")).alias("open_ended"))
    run = first_at_or_after(run, beats, "peak_t").withColumnRenamed("grid_t", "l_glance")
    run = first_at_or_after(run, beats, "run_end").withColumnRenamed("grid_t", "l_action")
    run = first_at_or_after(run, downbeats, "run_end").withColumnRenamed("grid_t", "l_hold")
    run = run.withColumns({"fallback": F.col("l_hold").isNull(), "l_hold": F.coalesce("l_hold", "l_action")}).filter("l_glance is not null and l_action is not null")
    clamp = lambda c: F.round(F.when(F.col(c) - F.col("start") < least, F.lit(least)).otherwise(F.least(F.col(c) - F.col("start"), F.least("dmax", F.lit(most)))), 3)
    run = run.withColumns({"glance": clamp("l_glance"), "action": clamp("l_action"), "hold": clamp("l_hold")})
    run = run.withColumn("action", F.greatest("glance", "action")).withColumn("hold", F.greatest("action", "hold"))
    return run.select(*keys, "n", "peak_t", "run_end", "open_ended", "glance", "action", "hold", "fallback")


def generate_candidates(events: DataFrame, durations: DataFrame) -> DataFrame:
    """Faces of each event (clip_id, entry_id, start, early): b_early if its roll-in stays inside the reel, b_glance, b_action, b_hold and hold_a, or hold_a alone."""
    rows = events.join(durations.select("clip_id", "entry_id", "glance", "action", "hold"), ["clip_id", "entry_id"], "left")
    has = F.col("glance").isNotNull()
    face = lambda when, name, start, d: F.when(when, F.struct(F.lit(name).alias("face"), start.cast("double").alias("start"), (start + d).cast("double").alias("end")))
    start, early = F.col("start"), F.col("start") - F.col("early")
    faces = F.array(
        face(has & (early >= 0), "b_early", early, F.col("action") + F.col("early")),
        face(has, "b_glance", start, F.col("glance")),
        face(has, "b_action", start, F.col("action")),
        face(has, "b_hold", start, F.col("hold")),
        face(F.lit(True), "hold_a", F.lit(None).cast("double"), F.lit(None).cast("double")),
    )
    return rows.select("clip_id", "entry_id", F.explode(F.filter(faces, lambda x: x.isNotNull())).alias("f")).select("clip_id", "entry_id", "f.face", "f.start", "f.end")


#: The eight scores and their weights.
WEIGHTS = {"sync": 0.10, "musical": 0.15, "action_score": 0.20, "quality": 0.10, "info_gain": 0.15, "continuity": 0.10, "novelty": 0.05, "coverage": 0.15}


def recommend(scored: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """weighted sum of scores rounded to 3 places first (a missing one counts 0), and per event the candidate of the greatest, the larger id of equals."""
    total = sum((F.coalesce(F.bround(F.col(c), 3), F.lit(0.0)) * w for c, w in (weights or WEIGHTS).items()), F.lit(0.0))
    rows = scored.withColumn("w", F.bround(total, 6))
    return rows.groupBy("job_id", "event").agg(F.max_by("candidate_id", F.struct("w", "candidate_id")).alias("recommended"), F.max("w").alias("w"), F.count("*").alias("n"))


def face_drift(predicted: DataFrame, emitted: DataFrame) -> DataFrame:
    """Rows of one side only, with the side: empty when what was emitted is what was predicted."""
    return predicted.exceptAll(emitted).withColumn("side", F.lit("predicted")).unionByName(emitted.exceptAll(predicted).withColumn("side", F.lit("emitted")))


def merge_events(base: DataFrame, extra: DataFrame) -> DataFrame:
    """Base and supplemental events (job_id, at) in time order, base first of equals, renumbered, with their origin."""
    every = base.select("job_id", "at", F.lit("base").alias("origin")).unionByName(extra.select("job_id", "at", F.lit("supplemental").alias("origin")))
    return every.withColumn("k", F.row_number().over(Window.partitionBy("job_id").orderBy("at", "origin"))).withColumn("event_id", F.format_string("ev_%03d", "k")).drop("k")
