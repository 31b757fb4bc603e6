"""Embedding whitening against numpy's eigenvectors, and its edge cases."""

from __future__ import annotations

from collections import defaultdict
from decimal import Decimal

import numpy as np
import pytest

from cutframe.llm import queries as q
from cutframe.llm import whitening
from cutframe.llm.common import ship_package


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def held(vectors: dict, got: list, components: int) -> None:
    """Rows against the definition, worked out in one place."""
    x = {i: np.floor(64 * np.asarray(v, dtype=np.float64)).astype(np.int64) + 1_000_000 for i, v in vectors.items()}
    fit = np.unique(np.array(list(x.values())), axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = (n * fit - s) / n
    e, p = np.linalg.eigh(c.T @ c / n)
    e, p = e[::-1][:components], p[:, ::-1][:, :components]
    rows = defaultdict(dict)
    for r in got:
        rows[r.vec_id][r.component] = r
    assert set(rows) == set(x)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    sign = None
    for i, v in x.items():
        assert sorted(rows[i]) == list(range(1, len(e) + 1))
        want = ((n * v - s) / n) @ p / np.sqrt(e)
        have = np.array([rows[i][k + 1].whitened for k in range(len(e))])
        if sign is None or (sign == 0).any():
            fresh = np.where(np.abs(want) > 1e-6, np.sign(want * have), 0)
            sign = fresh if sign is None else np.where(sign == 0, fresh, sign)
        assert np.abs(np.abs(have) - np.abs(want)).max() < 1e-8
        assert np.abs(have * sign - want)[sign != 0].max() < 1e-8
        for k in range(len(e)):
            r = rows[i][k + 1]
            assert (r.n, r.deviation) == (n, sum(int(a) ** 2 for a in n * v - s))
            assert abs(r.explained - e[k] / (c * c).sum() * n) < 1e-9


def test_query(spark, sf_dir):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    held(vectors, q.op12_embedding_whitening(spark, sf_dir).collect(), 16)


def test_block_as_wide_as_the_vectors_and_copies(spark):
    rng = np.random.default_rng(3)
    v = {i: (rng.standard_normal(5) * [9, 5, 3, 2, 1]).tolist() for i in range(40)}
    v |= {i: v[7] for i in range(40, 70)}
    held(v, whitening.whiten(spark.createDataFrame(list(v.items()), "vec_id long, embedding array<double>"), components=3).collect(), 3)


def test_narrow_block_over_a_wide_spectrum(spark):
    rng = np.random.default_rng(4)
    basis = np.linalg.qr(rng.standard_normal((60, 60)))[0]
    v = {i: (basis @ (rng.standard_normal(60) * 40 / np.arange(1, 61))).tolist() for i in range(300)}
    held(v, whitening.whiten(spark.createDataFrame(list(v.items()), "vec_id long, embedding array<double>"), components=4).collect(), 4)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], 7), (2, None, 7), (3, [nan, 1.0], 7), (4, [inf, 1.0], 7), (5, [None, 1.0], 7), (6, [], 7), (7, [1.0], 7), (8, [1e300, 1.0], 7), (None, [3.0, 1.0], 7), (9, [-2.0, 5.0], 7), (9, [-2.0, 5.0], 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, whitened int")
    got = whitening.whiten(df).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, r.component) for r in got) == sorted([(i is None, i or 0, k) for i in (1, None, 9, 9) for k in (1, 2)])
    assert {r.n for r in got} == {3}
    assert whitening.whiten(df.filter("false")).count() == 0
    assert whitening.whiten(df.filter("vec_id = 1")).count() == 0  # no variance
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, -float(i)]) for i in range(9)], "vec_id long, embedding array<float>")
    assert {(r.component, round(r.explained, 12)) for r in whitening.whiten(line).collect()} == {(1, 1.0)}


def test_integers_beyond_a_long_stay_exact(spark):
    rows = [(1, [2.0**50, 1.0]), (2, [-(2.0**50), 3.0]), (3, [0.0, 1000.0])]
    got = {r.vec_id: r for r in whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), components=1).collect()}
    assert {r.deviation for r in got.values()} == {None, (3 * 64000 - 64 * 1004) ** 2}
    assert abs(got[1].whitened + got[2].whitened) < 1e-6 and abs(abs(got[1].whitened) - 1.5**0.5) < 1e-9
    assert Decimal(got[1].explained) > Decimal("0.999999")


def test_filter_damps_and_grows():
    e = np.linspace(1, 2, 50)
    e[-3:] = [3, 4, 8]
    out = whitening.filtered(lambda x: e[:, None] * x, np.ones((50, 1)), e[:, None] * np.ones((50, 1)), 1.0, 2.0, 8.0, 6)[:, 0]
    assert abs(out[-1] - 1) < 1e-9 and np.abs(out[:-3]).max() < 1e-3 * abs(out[-3]) and abs(out[-3]) < abs(out[-2]) < 1
    assert 0 <= whitening.least_eigenvalue(lambda x: e[:, None] * x, 50, 10, 1) <= 1.0
