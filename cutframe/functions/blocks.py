"""Gaps-and-islands, nearest and as-of lookup, interval overlap and greedy selection, on the public DataFrame API."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, keys: Sequence[str], order: Sequence[str], starts: Column, name: str = "island") -> DataFrame:
    """Number the runs of rows per key: a row where `starts` is true (or null) begins a new run, from 1."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_new", F.coalesce(starts, F.lit(True)).cast("int")).withColumn(name, F.sum("_new").over(w)).drop("_new")


def around(points: DataFrame, grid: DataFrame, key: str, point: str, at: str, extra: Sequence[str] = ()) -> DataFrame:
    """For each point the grid rows before (at or before it) and after (at or after it), by one union and one window.

    Adds prev_<at>, next_<at> and the extra grid columns with these prefixes; null where there is none.
    """
    names = [at, *extra]
    g = F.struct(*(F.col(c).alias(c) for c in names))
    left = points.select(F.col(key).alias("_k"), F.col(point).alias("_t"), F.lit(1).alias("_side"), F.struct(*points.columns).alias("_row"), F.lit(None).cast(grid.select(g.alias("g")).schema["g"].dataType).alias("_g"))
    right = grid.select(F.col(key).alias("_k"), F.col(at).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(left.schema["_row"].dataType).alias("_row"), g.alias("_g"))
    both = left.unionByName(right)
    back = Window.partitionBy("_k").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("_k").orderBy(F.desc("_t"), "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumns({"_p": F.last("_g", ignorenulls=True).over(back), "_n": F.last("_g", ignorenulls=True).over(ahead)}).filter("_side = 1")
    return both.select("_row.*", *(F.col(f"_p.{c}").alias(f"prev_{c}") for c in names), *(F.col(f"_n.{c}").alias(f"next_{c}") for c in names))


def nearest(points: DataFrame, grid: DataFrame, key: str, point: str, at: str, extra: Sequence[str] = (), prefix: str = "near_") -> DataFrame:
    """The nearest grid row of each point; of two as near, the earlier. Adds near_<at> and near_<extra>."""
    both = around(points, grid, key, point, at, extra)
    p, n = F.col(f"prev_{at}"), F.col(f"next_{at}")
    first = p.isNotNull() & (n.isNull() | (F.col(point) - p <= n - F.col(point)))
    picked = {f"{prefix}{c}": F.when(first, F.col(f"prev_{c}")).otherwise(F.col(f"next_{c}")) for c in [at, *extra]}
    return both.withColumns(picked).drop(*(f"{s}_{c}" for s in ("prev", "next") for c in [at, *extra]))


def overlap(a: DataFrame, b: DataFrame, key: str, a_span: tuple[str, str], b_span: tuple[str, str], bucket: float, *, closed: bool = False, slack: float = 0.0) -> DataFrame:
    """Pairs of intervals of one key that overlap: both sides fall into time buckets, which are joined by equality.

    A pair is kept only in the later of the two first buckets, so it comes once. closed: touching counts, and points may
    be intervals of no length; slack widens b's intervals at both ends. Other columns of a and b must differ in name.
    """
    (s1, e1), (s2, e2) = a_span, b_span
    cell = lambda c: F.floor(c / bucket).cast("bigint")
    left = a.withColumns({"_a0": cell(F.col(s1)), "_cell": F.explode(F.sequence(cell(F.col(s1)), cell(F.greatest(F.col(s1), F.col(e1)))))})
    right = b.withColumnRenamed(key, "_key").withColumns({"_b0": cell(F.col(s2) - slack), "_cell2": F.explode(F.sequence(cell(F.col(s2) - slack), cell(F.greatest(F.col(s2), F.col(e2)) + slack)))})
    lo, hi = F.greatest(F.col(s1), F.col(s2) - slack), F.least(F.col(e1), F.col(e2) + slack)
    met = left.join(right, (F.col(key) == F.col("_key")) & (F.col("_cell") == F.col("_cell2")) & (F.col("_cell") == F.greatest("_a0", "_b0")))
    return met.filter(lo <= hi if closed else lo < hi).drop("_a0", "_b0", "_cell", "_cell2", "_key")


def apart(df: DataFrame, keys: Sequence[str], lo: Column, reach: Column, order: Sequence[str], *, closed: bool = False, name: str = "_part") -> DataFrame:
    """Number the parts of each key that a rule can't cross: a row whose lo lies at or beyond (closed: beyond) the reach of all rows before it begins a new one.

    One sweep over the sorted rows, which keeps the greatest reach so far and gathers nothing."""
    w = Window.partitionBy(*keys).orderBy("_lo", *order)
    rows = df.withColumns({"_lo": lo, "_reach": reach})
    before = F.max("_reach").over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_before", before)
    new = F.coalesce(F.col("_lo") > F.col("_before") if closed else F.col("_lo") >= F.col("_before"), F.lit(True)).cast("int")
    return rows.withColumn("_new", new).withColumn(name, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_lo", "_reach", "_before", "_new")


def greedy(df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, bool]], fields: Sequence[str], accept: Callable[[Column, Column], Column], limit: int | None = None) -> DataFrame:
    """Walk each group in order (column, descending) and keep a row if accept(kept so far, row).

    Groups are one clip's or one job's events, runs or cuts: hundreds of rows, gathered after all filters.
    """
    sorted_ = F.array_sort(F.collect_list(F.struct(*((-F.col(c) if down else F.col(c)).alias(f"_o{i}") for i, (c, down) in enumerate(order)), F.struct(*fields).alias("row"))))
    rows = df.groupBy(*keys).agg(sorted_.alias("_rows"))
    kind = df.select(F.array(F.struct(*fields)).alias("x")).schema["x"].dataType
    empty = F.array().cast(kind)

    def step(kept: Column, x: Column) -> Column:
        fits = accept(kept, x["row"])
        if limit is not None:
            fits = fits & (F.size(kept) < limit)
        return F.when(fits, F.array_append(kept, x["row"])).otherwise(kept)

    picked = rows.select(*keys, F.aggregate("_rows", empty, step).alias("_kept"))
    return picked.select(*keys, F.inline("_kept"))
