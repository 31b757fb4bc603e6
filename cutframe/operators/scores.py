"""The eight evidence scores of candidates, from sums between two times: one pass over marks and window ends gives every running sum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .music import musical_score
from .signals import intersection
from .windows import clamp01

#: The confidence that counts as fully sure, the coverage of a window without samples, the brightness aimed at, and the order of the scores.
SURE, UNCOVERED, BRIGHT = 5.0, 0.5, 128.0
NAMES = ("sync", "musical", "action", "quality", "info_gain", "continuity", "novelty", "coverage")
#: Ends of windows are widened by this much for samples.
SLACK = 1e-6


def unit(x: Column) -> Column:
    """x brought into 0 to 1; null stays null."""
    return F.when(x.isNotNull(), clamp01(x))


def sums_between(windows: DataFrame, marks: DataFrame, measures: list[str], slack: float = 0.0) -> DataFrame:
    """before_m and m for each measure: the sums of the marks (job_id, t, measures) before w0 and from w0 to w1, both widened by slack, by window (job_id, id, w0, w1).

    No pairs of windows and marks are made: marks and ends are sorted once in a job, and running sums read off at the ends."""
    zero = [F.lit(0.0).alias(m) for m in measures]
    start = windows.select("job_id", (F.col("w0") - slack).alias("t"), F.lit(0).alias("side"), "id", *zero)
    end = windows.select("job_id", (F.col("w1") + slack).alias("t"), F.lit(2).alias("side"), "id", *zero)
    mark = marks.select("job_id", "t", F.lit(1).alias("side"), F.lit(None).cast(windows.schema["id"].dataType).alias("id"), *(F.coalesce(F.col(m).cast("double"), F.lit(0.0)).alias(m) for m in measures))
    along = Window.partitionBy("job_id").orderBy("t", "side")
    rows = start.unionAll(end).unionAll(mark).select("job_id", "id", "side", *(F.sum(m).over(along).alias(m) for m in measures)).filter("side <> 1")
    at = lambda m, side: F.sum(F.when(F.col("side") == side, F.col(m)))
    return rows.groupBy("job_id", "id").agg(*(at(m, 0).alias(f"before_{m}") for m in measures), *((at(m, 2) - at(m, 0)).alias(m) for m in measures))


def area_between(windows: DataFrame, segs: DataFrame) -> DataFrame:
    """job_id, id, area, covered: segment scores (job_id, s0, s1, score) by the time they overlap a window, and that time."""
    ends = segs.filter("s1 > s0").select("job_id", "score", F.explode(F.array(F.struct(F.col("s0").alias("t"), F.lit(1.0).alias("d")), F.struct(F.col("s1").alias("t"), F.lit(-1.0).alias("d")))).alias("e"))
    d, t = F.col("e.d"), F.col("e.t")
    marks = ends.select("job_id", t.alias("t"), (d * F.col("score")).alias("a"), (d * F.col("score") * t).alias("b"), d.alias("c"), (d * t).alias("e"))
    got = sums_between(windows, marks, ["a", "b", "c", "e"]).join(windows, ["job_id", "id"])
    upto = lambda at, rate, amount: F.col(at) * rate - amount
    area = lambda p, q: upto("w1", F.col(f"before_{p}") + F.col(p), F.col(f"before_{q}") + F.col(q)) - upto("w0", F.col(f"before_{p}"), F.col(f"before_{q}"))
    return got.select("job_id", "id", area("a", "b").alias("area"), area("c", "e").alias("covered"))


def visual_between(windows: DataFrame, samples: DataFrame) -> DataFrame:
    """job_id, id, first, n, clean, any_flagged, sharpness, brightness of the samples (job_id, t, flagged, frozen, sharpness, brightness) in a window.

    flagged is null where obstruction wasn't measured: such a sample isn't clean, nor is it flagged. first counts the samples before the window."""
    s = samples.select(
        "job_id",
        "t",
        F.lit(1.0).alias("n"),
        F.coalesce(~F.col("flagged") & ~F.coalesce("frozen", F.lit(False)), F.lit(False)).cast("double").alias("clean"),
        (F.coalesce("flagged", F.lit(False)) | F.coalesce("frozen", F.lit(False))).cast("double").alias("bad"),
        "sharpness",
        F.col("sharpness").isNotNull().cast("double").alias("sharp_n"),
        "brightness",
        F.col("brightness").isNotNull().cast("double").alias("bright_n"),
    )
    g = sums_between(windows, s, s.columns[2:], SLACK)
    return g.select(
        "job_id",
        "id",
        F.col("before_n").cast("bigint").alias("first"),
        F.col("n").cast("bigint").alias("n"),
        F.try_divide("clean", "n").alias("clean"),
        (F.col("bad") > 0).alias("any_flagged"),
        F.try_divide("sharpness", "sharp_n").alias("sharpness"),
        F.try_divide("brightness", "bright_n").alias("brightness"),
    )


def similarity_between(pairs: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """job_id, id, similarity: mean histogram intersection of samples paired by their place in two windows; pairs(job_id, id, a_first, a_n, b_first, b_n)."""
    def at(side: str, samples: DataFrame) -> DataFrame:
        place = F.row_number().over(Window.partitionBy("job_id").orderBy("t"))
        return samples.select("job_id", place.alias(f"{side}_at"), F.col("hist").alias(f"{side}_hist"))

    i = F.explode(F.when(F.least("a_n", "b_n") > 0, F.sequence(F.lit(1).cast("bigint"), F.least("a_n", "b_n"))).otherwise(F.array().cast("array<bigint>")))
    rows = pairs.select("job_id", "id", "a_first", "b_first", i.alias("i")).select("job_id", "id", (F.col("a_first") + F.col("i")).alias("a_at"), (F.col("b_first") + F.col("i")).alias("b_at"))
    met = rows.join(at("a", a), ["job_id", "a_at"]).join(at("b", b), ["job_id", "b_at"]).filter("size(a_hist) > 0 and size(b_hist) > 0")
    return met.groupBy("job_id", "id").agg(F.avg(intersection(F.col("a_hist"), F.col("b_hist"))).alias("similarity"))


def quality(win: dict[str, Column], p90: Column, kf: dict[str, Column]) -> Column:
    """Half sharpness against the 90th percentile, half nearness to the brightness aimed at: from keyframes where usable, else from the window's samples, else 0."""
    bright = lambda b: unit(1 - F.abs(b - BRIGHT) / BRIGHT)
    reference = F.when(p90 > 0, p90).otherwise(1.0)
    from_keyframes = unit(0.5 * unit(kf["sharpness"] / kf["p90"]) + 0.5 * bright(F.when(kf["brightness"] != 0, kf["brightness"]).otherwise(BRIGHT)))
    from_samples = unit(0.5 * unit(win["sharpness"] / reference) + 0.5 * F.coalesce(bright(win["brightness"]), F.lit(0.0)))
    return F.when(F.coalesce(kf["usable"] & (kf["p90"] > 0) & kf["sharpness"].isNotNull(), F.lit(False)), from_keyframes).when(win["sharpness"].isNotNull(), from_samples).otherwise(0.0)


def score_candidates(
    cands: DataFrame,
    *,
    path: DataFrame,
    segs: DataFrame,
    a_samples: DataFrame,
    b_samples: DataFrame,
    grids: dict[str, DataFrame],
    keyframes: DataFrame,
    sync: DataFrame,
    recovery: float,
    novelty_cap: float,
) -> DataFrame:
    """job_id, event, candidate_id and the eight scores, 0 to 1, rounded to 3 places.

    cands(job_id, event, candidate_id, switch, t0, t1, s0, s1): on the timeline t0 to t1 it shows s0 to s1 of B (switch), or A goes on (hold).
    path(job_id, event, t0, t1, s0, s1): the window that each event has by default; segs(job_id, s0, s1, score): B's action; a_samples and b_samples
    (job_id, t, flagged, frozen, sharpness, brightness, hist); grids beat, down, phrase (clip_id, t); keyframes(job_id, usable, sharpness, brightness, p90);
    sync(job_id, confidence), without a row of a job it is declared to be in sync. A hold's action and novelty and info_gain are 0 and its continuity 1; a window without
    samples has coverage 0.5, one with a flagged or frozen sample 0.
    """
    rows = cands.withColumn("id", F.struct("event", "candidate_id"))
    in_b = rows.select("job_id", "id", F.col("s0").alias("w0"), F.col("s1").alias("w1"))
    in_a = rows.select("job_id", "id", F.col("t0").alias("w0"), F.col("t1").alias("w1"))

    def reel(samples: DataFrame, side: str) -> DataFrame:
        return samples.groupBy("job_id").agg(F.percentile("sharpness", 0.9).alias(f"{side}_p90"))

    def side(windows: DataFrame, samples: DataFrame, name: str) -> DataFrame:
        seen = visual_between(windows, samples)
        return seen.select("job_id", "id", *(F.col(c).alias(f"{name}_{c}") for c in seen.columns[2:]))

    out = rows.join(side(in_a, a_samples, "a"), ["job_id", "id"], "left").join(side(in_b, b_samples, "b"), ["job_id", "id"], "left")
    alike = similarity_between(out.filter("switch").select("job_id", "id", "a_first", "a_n", "b_first", "b_n"), a_samples, b_samples)
    out = out.join(alike, ["job_id", "id"], "left").join(area_between(in_b, segs), ["job_id", "id"], "left")
    out = out.join(segs.groupBy("job_id").agg(F.max("score").alias("most")), "job_id", "left").join(reel(a_samples, "a"), "job_id", "left").join(reel(b_samples, "b"), "job_id", "left")
    out = out.join(keyframes.select("job_id", *(F.col(c).alias(f"k_{c}") for c in ("usable", "sharpness", "brightness", "p90"))), "job_id", "left")
    out = out.join(sync.select("job_id", "confidence", F.lit(True).alias("measured")), "job_id", "left")
    order = Window.partitionBy("job_id").orderBy("t0", "event")
    before = path.select("job_id", "event", F.lag("t1").over(order).alias("left_at"), F.lag("s1").over(order).alias("left_source"))
    out = out.join(before, ["job_id", "event"], "left")
    points = rows.select(F.col("job_id").alias("clip_id"), "id", F.col("t0").alias("t"))
    out = out.join(musical_score(points, grids).select(F.col("clip_id").alias("job_id"), "id", F.col("musical").alias("_musical")), ["job_id", "id"], "left")

    seen = {c: F.when(F.col("switch"), F.col(f"b_{c}")).otherwise(F.col(f"a_{c}")) for c in ("n", "clean", "any_flagged", "sharpness", "brightness", "p90")}
    gap = F.col("t0") - F.coalesce("left_at", F.lit(0.0))
    ordered = F.col("s0") >= F.col("left_source") - 1e-9
    short = unit(gap / recovery) if recovery > 0 else F.lit(1.0)
    switched = lambda value, held: F.when(F.col("switch"), value).otherwise(held)
    scores = {
        "sync": F.when(F.col("measured"), unit(F.coalesce("confidence", F.lit(0.0)) / SURE)).otherwise(1.0),
        "musical": F.coalesce("_musical", F.lit(0.0)),
        "action": switched(F.when(F.col("most") > 0, F.coalesce(unit(F.when(F.col("covered") > 1e-9, F.col("area") / F.col("covered")) / F.col("most")), F.lit(0.0))).otherwise(0.0), F.lit(0.0)),
        "quality": quality(seen, seen["p90"], {c: F.col(f"k_{c}") for c in ("usable", "sharpness", "brightness", "p90")}),
        "info_gain": switched(F.coalesce(unit(1 - F.col("similarity")), F.lit(0.0)), F.lit(0.0)),
        "continuity": switched(F.when(F.col("left_at").isNull() | ((gap >= recovery - 1e-9) & ordered), F.lit(1.0)).when(ordered, short).otherwise(F.least(short, F.lit(0.25))), F.lit(1.0)),
        "novelty": switched(unit(gap / novelty_cap) if novelty_cap > 0 else F.lit(0.0), F.lit(0.0)),
        "coverage": F.when(F.coalesce(seen["n"], F.lit(0)) == 0, F.lit(UNCOVERED)).when(seen["any_flagged"], 0.0).otherwise(unit(seen["clean"])),
    }
    return out.select("job_id", "event", "candidate_id", *(F.bround(scores[n], 3).alias(n) for n in NAMES))
