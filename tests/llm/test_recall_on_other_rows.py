"""Nearest neighbours on rows unlike the table's: no clusters at all, and clusters far narrower than the distances between them."""

from __future__ import annotations

import numpy as np
import pytest

from cutframe.llm import ann
from cutframe.llm.common import ship_package


def rows(kind: str, n: int) -> np.ndarray:
    rng = np.random.default_rng(0)
    x = rng.standard_normal((n, 64))
    return x if kind == "isotropic" else rng.standard_normal((20, 64))[rng.integers(0, 20, n)] + 0.01 * x + (1000 if kind == "far" else 0)


@pytest.mark.parametrize(("kind", "n"), [("isotropic", 6000), ("narrow", 3000), ("far", 3000)])
def test_recall(spark, kind, n):
    ship_package(spark)
    x, got = rows(kind, n), {}
    for r in ann.nearest(spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
        assert r.score == pytest.approx(float(x[r.query_id] @ x[r.vec_id]), rel=1e-12)
    assert sorted(got) == list(range(0, n, 20))
    s = x[::20] @ x.T
    s[np.arange(len(s)), np.arange(0, n, 20)] = -np.inf
    found = [len(got[20 * i] & set(row)) for i, row in enumerate(np.argsort(-s, axis=1)[:, :20].tolist())]
    assert sum(found) >= 0.95 * 20 * len(found)
