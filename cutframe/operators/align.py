"""Multi-source alignment: correlation offsets, sync maps, derived source times."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.blocks import around, nearest


#: Samples of a block in correlations: a task holds a few blocks at a time, a long series is spread over many.
BLOCK = 4096


def _block_products(length: int, keys: int):
    """Products of one block of a with two blocks of b at each lag inside a block, by FFT."""

    def dense(place: pa.Array, x: pa.Array, size: int) -> np.ndarray:
        out = np.zeros(size)
        np.add.at(out, place.to_numpy(), x.to_numpy())
        return out

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = []
            for a, b, lags in zip(batch.column("a"), batch.column("b"), batch.column("lags"), strict=True):
                fa = np.fft.rfft(dense(a.values.field("i"), a.values.field("x"), length), 2 * length)
                fb = np.fft.rfft(dense(b.values.field("i"), b.values.field("x"), 2 * length))
                sums.append(np.fft.irfft(np.conj(fa) * fb, 2 * length)[: lags.as_py()])
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(keys)), batch.column("chunk"), pa.array(sums, pa.list_(pa.float64()))], names=[*batch.schema.names[:keys], "chunk", "s"])

    return work


def correlate(a: DataFrame, b: DataFrame, rooms: DataFrame, keys: list[str], length: int = BLOCK) -> DataFrame:
    """(keys, lag, s): the sum of a[n] * b[n + lag] at every lag from 0 to room, by blocks: overlap-save.

    a, b: (keys, n, x), missing samples count 0; rooms: (some of the keys, room). A block of a meets a block of b for each block of lags; the
    products inside a pair of blocks take length * log(length) steps, and their sums are added up by lag.
    """
    block = F.floor(F.col("n") / length).cast("bigint")
    sample = lambda i: F.collect_list(F.struct(i.cast("int").alias("i"), F.col("x").cast("double").alias("x")))
    x = a.withColumn("block", block).groupBy(*keys, "block").agg(sample(F.col("n") - F.col("block") * length).alias("a"))
    x = x.join(rooms.filter("room >= 0"), [k for k in keys if k in rooms.columns])
    x = x.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("room") / length)))).withColumn("at", F.col("block") + F.col("chunk"))
    y = b.withColumn("at", F.explode(F.array(block, block - 1))).groupBy(*keys, "at").agg(sample(F.col("n") - F.col("at") * length).alias("b"))
    lags = F.least(F.lit(length), F.col("room") + 1 - F.col("chunk") * length).cast("int")
    rows = x.join(y, [*keys, "at"]).select(*keys, "chunk", lags.alias("lags"), "a", "b")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*keys, "chunk").schema) + ", s array<double>"
    sums = rows.mapInArrow(_block_products(length, len(keys)), schema).select(*keys, "chunk", F.posexplode("s").alias("i", "s"))
    return sums.groupBy(*keys, (F.col("chunk") * length + F.col("i")).alias("lag")).agg(F.sum("s").alias("s"))


def lag_products(ref: DataFrame, clip: DataFrame, max_lag: int, keys: tuple[str, ...] = ("pair",)) -> DataFrame:
    """(keys, lag, c, n): mean product of mean-removed series at each lag, over their true overlap. ref, clip: (keys, n, x)."""
    w = Window.partitionBy(*keys)
    flat = lambda df: df.filter("x is not null").withColumn("x", F.col("x") - F.avg("x").over(w)).select(*keys, "n", "x")
    a, b = flat(ref), flat(clip).withColumn("n", F.col("n") + max_lag)
    rooms = ref.select(*keys).distinct().withColumn("room", F.lit(2 * max_lag))
    one = lambda df: df.withColumn("x", F.lit(1.0))
    both = correlate(a, b, rooms, list(keys)).join(correlate(one(a), one(b), rooms, list(keys)).withColumnRenamed("s", "n"), [*keys, "lag"])
    n = F.round("n").cast("bigint")
    return both.withColumn("n", n).filter("n > 0").select(*keys, (max_lag - F.col("lag")).cast("int").alias("lag"), F.round(F.col("s") / F.col("n"), 9).alias("c"), "n")


def xcorr_offset(ref: DataFrame, clip: DataFrame, max_lag: int, least: int = 8, rate: float = 1.0) -> DataFrame:
    """Per pair: offset in seconds at the greatest absolute correlation (least lag of equals), refined by a parabola, and confidence = peak over median."""
    c = lag_products(ref, clip, max_lag).filter(F.col("n") >= least)
    w = Window.partitionBy("pair").orderBy("lag")
    c = c.withColumns({"c0": F.when(F.lag("lag").over(w) == F.col("lag") - 1, F.lag("c").over(w)), "c2": F.when(F.lead("lag").over(w) == F.col("lag") + 1, F.lead("c").over(w))})
    g = c.groupBy("pair").agg(F.min_by(F.struct("lag", "c", "c0", "c2"), F.struct(-F.abs(F.col("c")), "lag")).alias("p"), F.percentile(F.abs("c"), 0.5).alias("med"))
    denom = F.col("p.c0") - 2 * F.col("p.c") + F.col("p.c2")
    shift = F.coalesce(F.when(F.abs(denom) > 1e-12, 0.5 * (F.col("p.c0") - F.col("p.c2")) / denom), F.lit(0.0))
    return g.select("pair", F.col("p.lag").alias("lag"), ((F.col("p.lag") + shift) / rate).alias("offset_s"), (F.abs("p.c") / F.coalesce(F.nullif("med", F.lit(0.0)), F.lit(1.0))).alias("confidence"))


def band_offset(ref: DataFrame, clip: DataFrame, length: int = BLOCK) -> DataFrame:
    """Per pair: the lag, of all at which the whole of ref lies inside clip, with the greatest sum over bands of absolute correlation, against the mean of all others. series: (pair, band, n, x), n from 0."""
    rooms = clip.groupBy("pair").agg(F.max("n").alias("last")).join(ref.groupBy("pair").agg(F.max("n").alias("end")), "pair").select("pair", (F.col("last") - F.col("end")).alias("room"))
    per_band = correlate(ref, clip, rooms, ["pair", "band"], length)
    total = per_band.groupBy("pair", "lag").agg(F.round(F.sum(F.abs("s")), 6).alias("s"))
    g = total.groupBy("pair").agg(F.min_by("lag", F.struct(-F.col("s"), "lag")).alias("lag"), F.max("s").alias("best"), F.sum("s").alias("all"), F.count("*").alias("n"))
    return g.select("pair", "lag", "best", F.try_divide(F.col("all") - F.col("best"), F.col("n") - 1).alias("others"))


def validate_sync_map(jobs: DataFrame, cards: DataFrame, budget: float = 0.036) -> DataFrame:
    """job_id, problem (one row each). jobs(job_id, schema_version, reference_angle, tolerance_s, lag_s), cards(job_id, idx, offset, duration_s)."""
    w = Window.partitionBy("job_id").orderBy("idx")
    good = (F.col("offset") >= 0) & (F.col("duration_s") > 0)
    prev = F.last(F.when(good, F.col("offset") + F.col("duration_s")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    c = cards.withColumn("prev", prev)
    rule = F.when(F.col("offset").isNull() | (F.col("offset") < 0), "bad_offset").when(F.col("duration_s").isNull() | (F.col("duration_s") <= 0), "bad_duration").when(F.abs(F.col("offset") - F.col("prev")) > budget, "discontinuous")
    per_card = c.select("job_id", F.concat(rule, F.lit(":"), F.col("idx").cast("string")).alias("problem"))
    n = cards.groupBy("job_id").agg(F.count("*").alias("n"), F.min_by("offset", "idx").alias("first"))
    j = jobs.join(n, "job_id", "left")
    lag = F.coalesce("lag_s", "first")
    rules = F.array(
        F.when(~F.col("schema_version").eqNullSafe(F.lit(1)), "schema_version"),
        F.when(~F.col("reference_angle").eqNullSafe(F.lit("A")), "reference_angle"),
        F.when(F.col("n").isNull(), "no_cards"),
        F.when(F.col("tolerance_s").isNull() | (F.col("tolerance_s") < 0) | (F.col("tolerance_s") > budget), "tolerance"),
        F.when(lag.isNull() | (lag <= 0), "lag"),
    )
    return j.select("job_id", F.explode(rules).alias("problem")).unionByName(per_card).filter("problem is not null")


def sync_entry(events: DataFrame, lag: str = "lag_s", fps: float = 30000 / 1001, budget: float = 0.036) -> DataFrame:
    """entry: event time minus lag, snapped to a frame where the move is within the budget; residual is the move."""
    raw = F.col("anchor") - F.col(lag)
    snapped = F.bround(raw * fps, 0) / fps
    fine = F.abs(snapped - raw) <= budget
    return events.withColumns({"entry": F.when(fine, snapped).otherwise(raw), "residual": F.when(fine, snapped - raw).otherwise(F.lit(0.0))})


def entry_coverage(entries: DataFrame, samples: DataFrame, near: float = 1.0, flag: float = 0.5) -> DataFrame:
    """ok and reason: entry inside the reel (reel_end), a sample within `near`, not frozen, not obstructed. entries(clip_id, entry, reel_end, ...)."""
    n = nearest(entries, samples.select("clip_id", "t", "frozen", "obstruction"), "clip_id", "entry", "t", ["frozen", "obstruction"])
    reason = (
        F.when(F.col("entry") < 0, "before_reel").when(F.col("entry") > F.col("reel_end"), "past_reel").when(F.col("near_t").isNull(), "no_samples").when(F.abs(F.col("near_t") - F.col("entry")) > near, "no_sample_near").when(F.col("near_frozen"), "frozen").when(F.col("near_obstruction") >= flag, "obstructed").otherwise("clean")
    )
    return n.select(*entries.columns, reason.alias("reason")).withColumn("ok", F.col("reason") == "clean")


def reel_address(points: DataFrame, reel: DataFrame, key: str = "reel") -> DataFrame:
    """name and in-file time of each virtual time (key, t); the last file takes the tail."""
    both = around(points, reel.select(F.col("reel").alias(key), F.col("start").alias("v0"), "name"), key, "t", "v0", ["name"])
    return both.select(*points.columns, F.col("prev_name").alias("name"), (F.col("t") - F.col("prev_v0")).alias("in_file"))


def sync_residuals(cands: DataFrame, lag: float, tolerance: float = 0.036) -> DataFrame:
    """Per event: worst |(timeline_start - start) - lag|, and whether it is within the tolerance."""
    g = cands.groupBy("job_id", "event").agg(F.max(F.abs(F.col("timeline_start") - F.col("start") - lag)).alias("worst"), F.count("*").alias("n"))
    return g.withColumn("ok", F.col("worst") <= tolerance)
