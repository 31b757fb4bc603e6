"""The greedy search of op1: what a hop writes, and queries whose node has no edges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from cutframe.llm import ann
from cutframe.llm.common import ship_package


def test_a_hop_writes_one_row_a_query_and_lonely_nodes_are_served(spark, monkeypatch):
    ship_package(spark)
    x = np.random.default_rng(0).standard_normal((300, 16))
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    s[:, 0] = s[0, :] = -np.inf  # node 0 has no edges
    edges = [(a, int(b), float(s[a, b]), r + 1) for a in range(1, 300) for r, b in enumerate(np.argsort(-s[a])[:24])]
    nodes = spark.createDataFrame(list(enumerate(x.tolist())), "node long, v array<double>")
    frame = ann.Frame(np.zeros(16), float(np.abs(x).max()))
    packed = ann.written(nodes.mapInArrow(ann._packed(frame), "node bigint, scale float, q binary"), "vectors")
    graph = ann.written(spark.createDataFrame(edges, "a long, b long, s float, r int").withColumn("s", F.col("s") / F.lit(frame.unit**2).cast("float")), "graph")
    queries = spark.createDataFrame([(i,) for i in range(0, 300, 20)], "query long")
    truth = ann.yardstick(nodes, queries, 20).filter("query <> 0")
    rows, write = [], ann.written

    def counted(df, name):
        out = write(df, name)
        if name == "search":
            rows.append(out.count())
        return out

    monkeypatch.setattr(ann, "written", counted)
    got = {}
    for r in ann.greedy_search(graph, packed, frame, queries, truth).filter("query <> node").collect():
        got.setdefault(r.query, set()).add(r.node)
    assert rows and set(rows) == {15}
    assert sorted(got) == list(range(0, 300, 20)) and min(map(len, got.values())) >= 20
    held = truth.collect()
    assert sum(r.node in got[r.query] for r in held) >= 0.96 * len(held)
