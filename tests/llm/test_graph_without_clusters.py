"""The graph of op1 on rows without clusters: a poor one makes the search grow wider with the table."""

from __future__ import annotations

import numpy as np

from cutframe.llm import ann
from cutframe.llm.common import ship_package


def test_lists_hold_the_true_neighbours(spark):
    ship_package(spark)
    x = np.random.default_rng(0).standard_normal((6000, 64))
    graph, _, _ = ann.neighbour_graph(spark.createDataFrame(list(enumerate(x.tolist())), "node long, v array<double>"))
    lists = {}
    for r in graph.filter("a % 20 = 0").collect():
        lists.setdefault(r.a, set()).add(r.b)
    s = x[::20] @ x.T
    s[np.arange(len(s)), np.arange(0, 6000, 20)] = -np.inf
    held = [len(lists[20 * i] & set(row)) for i, row in enumerate(np.argsort(-s, axis=1)[:, :20].tolist())]
    assert sum(held) >= 0.9 * 20 * len(held)
