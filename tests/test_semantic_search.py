"""Vector search by blocks against plain sorting."""

from __future__ import annotations

import numpy as np
import pytest

from cutframe.operators import search as se


@pytest.mark.parametrize("limit", [32 << 20, 700])
def test_search_by_blocks(spark, monkeypatch, limit):
    monkeypatch.setattr(se, "QUERY_BYTES", limit)  # the second in several passes
    rng = np.random.default_rng(1)
    x = rng.integers(-3, 4, (500, 6)).astype(float)  # many ties
    odd = [(900, None), (901, [1.0]), (902, [None] * 6), (None, [1.0] * 6), (903, [])]
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + odd, "vec_id long, embedding array<float>").repartition(5)
    asked = {i: x[i] for i in range(0, 500, 25)}
    queries = spark.createDataFrame([(f"q{i}", v.tolist()) for i, v in asked.items()] + [("none", None), ("wide", [1.0] * 9), ("odd", [None, 1.0])], "query_id string, qv array<double>")
    got = {}
    for r in se.semantic_search(vectors, queries, 7).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {f"q{i}" for i in asked}
    for i, v in asked.items():
        score = np.round(x @ v / ((np.sqrt((x * x).sum(axis=1)) + 1e-9) * (np.sqrt(v @ v) + 1e-9)), 6)
        order = np.lexsort((np.arange(500), -score))[:7]
        assert sorted(got[f"q{i}"]) == [(n, j, pytest.approx(score[j], abs=2e-6)) for n, j in enumerate(order, 1)]
    assert se.semantic_search(vectors, queries.filter("false"), 7).count() == 0
    assert se.semantic_search(vectors.filter("false"), queries, 7).count() == 0
    plan = se.semantic_search(vectors, queries, 7)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_a_task_holds_few_scores_at_a_time():
    """Queries by the thousand against a batch of 10,000 vectors: every pair of them at once would take hundreds of MB."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(2)
    x, q = rng.integers(-3, 4, (10_000, 4)).astype(float), rng.integers(-3, 4, (2000, 4)).astype(float)
    ids = rng.permutation(10_000)
    batch = lambda a, b: pa.RecordBatch.from_arrays([pa.array(ids[a:b]), pa.array(x[a:b].tolist(), pa.list_(pa.float64()))], names=["vec_id", "embedding"])
    batches = [batch(0, 9000), batch(9000, 9003), batch(9003, 10_000)]
    work = se._nearest(list(range(2000)), q, 5)
    tracemalloc.start()
    (got,) = work(iter(batches))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 100 << 20
    place, vec = got.column("place").to_numpy(), got.column("vec_id").to_numpy()
    for i in range(0, 2000, 97):
        score = np.round(x @ (q[i] / (np.sqrt(q[i] @ q[i]) + 1e-9)) / (np.sqrt((x * x).sum(axis=1)) + 1e-9), 6)
        assert vec[place == i].tolist() == ids[np.lexsort((ids, -score))[:5]].tolist()
