"""Connected components by label propagation with pointer jumping, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, comp): comp is the least id of the component. links(a, b) are undirected; ids without a link are absent.

    Each round takes the least label of the neighbours, then follows labels one step further, so a
    path of n nodes needs about log n rounds. Labels stay in tables; only a count reaches the driver.
    """
    edges = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct(), "edges")
    labels = written(edges.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("id"), F.least("a", "least").alias("comp")), "labels")
    for _ in range(rounds):
        near = edges.join(labels.select(F.col("id").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("near"))
        better = labels.join(near, labels.id == near.a).select("id", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("id").alias("comp"), F.col("comp").alias("further"))
        step = written(better.join(jump, "comp", "left").select("id", "old", F.least("comp", F.coalesce("further", "comp")).alias("comp")), "labels")
        moved = step.filter("comp <> old").limit(1).count()
        discard(labels)
        labels = step
        if not moved:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return labels.select("id", "comp")


def extended(comps: DataFrame, links: DataFrame) -> DataFrame:
    """The components (id, comp) after more links(a, b): only components that a new link joins are looked at again."""
    a, b = comps.select(F.col("id").alias("a"), F.col("comp").alias("ca")), comps.select(F.col("id").alias("b"), F.col("comp").alias("cb"))
    between = links.select("a", "b").join(a, "a", "left").join(b, "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    roots = components(between)
    moved = comps.join(roots.select(F.col("id").alias("comp"), F.col("comp").alias("root")), "comp", "left").select("id", F.coalesce("root", "comp").alias("comp"))
    fresh = roots.join(comps.select("id"), "id", "left_anti")  # ids without a link so far; a component's own id is among its ids
    return written(moved.unionByName(fresh.select("id", "comp")), "labels")
