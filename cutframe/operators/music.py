"""Beat grid, bars, phrases, and where instants stand on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.blocks import around, greedy, nearest


def bpm(beats: DataFrame) -> DataFrame:
    """clip_id, bpm from the upper median of positive gaps; clips of more than four beats."""
    w = Window.partitionBy("clip_id").orderBy("t")
    gaps = beats.withColumn("gap", F.lead("t").over(w) - F.col("t"))
    g = gaps.groupBy("clip_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.when(F.col("gap") > 0, F.col("gap")))).alias("gaps"))
    middle = F.element_at("gaps", F.floor(F.size("gaps") / 2).cast("int") + 1)
    return g.filter("n > 4 and size(gaps) > 0").select("clip_id", "n", (60.0 / middle).alias("bpm"))


def bars(beats: DataFrame, k: int = 4, phase: int = 0) -> DataFrame:
    """clip_id, bar from 0, start, end: each k-th beat from phase; the last bar ends at the clip's final beat."""
    last = beats.groupBy("clip_id").agg(F.max("t").alias("final"))
    w = Window.partitionBy("clip_id").orderBy("start")
    down = beats.filter(F.pmod(F.col("i") - phase, F.lit(k)) == 0).select("clip_id", F.col("t").alias("start")).join(last, "clip_id")
    return down.select("clip_id", (F.row_number().over(w) - 1).alias("bar"), "start", F.coalesce(F.lead("start").over(w), "final").alias("end"))


def phrases(bars_: DataFrame, n: int = 8) -> DataFrame:
    """clip_id, phrase from 0, start, end, bars, start_bar, complete."""
    g = bars_.groupBy("clip_id", F.floor(F.col("bar") / n).cast("bigint").alias("phrase"))
    return g.agg(F.min("start").alias("start"), F.max_by("end", "bar").alias("end"), F.count("*").alias("bars"), F.min("bar").alias("start_bar")).withColumn("complete", F.col("bars") == n)


def musical_context(points: DataFrame, beats: DataFrame, bars_: DataFrame, phrases_: DataFrame, at: str = "t") -> DataFrame:
    """Nearest beat and downbeat with signed distance, the phrase that holds the instant, bars into it, boundary flags."""
    p = nearest(points, beats.select("clip_id", F.col("t").alias("beat")), "clip_id", at, "beat")
    p = nearest(p, bars_.select("clip_id", F.col("start").alias("down")), "clip_id", at, "down")
    p = around(p, phrases_.select("clip_id", F.col("start").alias("phrase_start"), "phrase", "start_bar", F.col("end").alias("phrase_end")), "clip_id", at, "phrase_start", ["phrase", "start_bar", "phrase_end"])
    p = around(p, bars_.select("clip_id", F.col("start").alias("bar_start"), "bar"), "clip_id", at, "bar_start", ["bar"])
    return p.select(
        *points.columns,
        (F.col(at) - F.col("near_beat")).alias("beat_delta"),
        (F.col(at) - F.col("near_down")).alias("downbeat_delta"),
        F.col("prev_phrase").alias("phrase"),
        (F.col("prev_bar") - F.col("prev_start_bar")).alias("bars_in"),
        (F.abs(F.col(at) - F.col("near_down")) <= 1e-3).alias("at_downbeat"),
        (F.abs(F.col(at) - F.col("prev_phrase_start")) <= 1e-3).alias("at_phrase"),
    )


#: Score, tolerance in seconds, for beat, downbeat, phrase.
RAMPS = (("beat", 0.75, 0.12), ("down", 0.90, 0.25), ("phrase", 1.00, 0.50))


def musical_score(points: DataFrame, grids: dict[str, DataFrame], at: str = "t") -> DataFrame:
    """The greatest of three ramps: value * max(0, 1 - distance / tolerance) to the nearest of each grid (clip_id, t)."""
    out, ramps = points, []
    for name, value, tolerance in RAMPS:
        out = nearest(out, grids[name].select("clip_id", F.col("t").alias(name)), "clip_id", at, name)
        ramps.append(F.coalesce(F.greatest(F.lit(0.0), 1 - F.abs(F.col(at) - F.col(f"near_{name}")) / tolerance) * value, F.lit(0.0)))
    return out.select(*points.columns, F.greatest(*ramps).alias("musical"))


def quantize(cuts: DataFrame, beats: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """Cut boundaries moved to the nearest beat within the tolerance; moved counts how many of the two did."""
    ends = cuts.select("job_id", "pos", F.expr("stack(2, 'in', source_in, 'out', source_out) as (side, t)"))
    near = nearest(ends, beats.select(F.col("clip_id").alias("job_id"), F.col("t").alias("beat")), "job_id", "t", "beat")
    moves = (F.abs(F.col("near_beat") - F.col("t")) <= tolerance) & (F.col("near_beat") != F.col("t"))
    near = near.withColumns({"q": F.when(F.coalesce(moves, F.lit(False)), F.col("near_beat")).otherwise(F.col("t")), "moved": F.coalesce(moves, F.lit(False)).cast("int")})
    pair = near.groupBy("job_id", "pos").agg(F.max(F.when(F.col("side") == "in", F.col("q"))).alias("q_in"), F.max(F.when(F.col("side") == "out", F.col("q"))).alias("q_out"), F.sum("moved").alias("moved"))
    return pair


def first_at_or_after(points: DataFrame, grid: DataFrame, at: str = "t", slack: float = 1e-9) -> DataFrame:
    """The first grid value at or after each point, null past the end."""
    shifted = points.withColumn("_at", F.col(at) - slack)
    return around(shifted, grid.select("clip_id", F.col("t").alias("grid_t")), "clip_id", "_at", "grid_t").select(*points.columns, F.col("next_grid_t").alias("grid_t"))


def pick_events(downbeats: DataFrame, beats: DataFrame, spans: DataFrame, gap: float, n: int) -> DataFrame:
    """clip_id, t, kind: up to n instants of each span (clip_id, lo, hi), bounds included, at least gap (less 1e-9) apart: downbeats, or beats where the span has fewer than n downbeats."""
    within = lambda grid, kind: grid.join(spans, "clip_id").filter("t >= lo and t <= hi").select("clip_id", "t", F.lit(kind).alias("kind"))
    down = within(downbeats, "downbeat")
    enough = down.groupBy("clip_id").agg(F.count("*").alias("n")).filter(F.col("n") >= n).select("clip_id")
    pool = down.join(enough, "clip_id", "left_semi").unionByName(within(beats, "beat").join(enough, "clip_id", "left_anti"))
    return greedy(pool, ["clip_id"], [("t", False)], ["t", "kind"], lambda kept, x: (F.size(kept) == 0) | (x["t"] - F.element_at(kept, -1)["t"] >= gap - 1e-9), n)
