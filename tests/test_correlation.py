"""Correlation by blocks against numpy, over many blocks."""

from __future__ import annotations

import numpy as np
import pytest

from cutframe.operators import align as al


@pytest.mark.parametrize("length", [4, 16, 4096])
def test_blocks(spark, length):
    rng = np.random.default_rng(2)
    series = {(p, b): (rng.standard_normal(20 + 7 * p), rng.standard_normal(90 + 11 * p)) for p in range(3) for b in range(2)}
    rows = lambda side: spark.createDataFrame([(p, b, n, float(x)) for (p, b), s in series.items() for n, x in enumerate(s[side]) if (n + b) % 9], "pair int, band int, n long, x double")
    rooms = spark.createDataFrame([(p, 70 + 4 * p) for p in range(2)] + [(2, -1)], "pair int, room long")
    got = {(r.pair, r.band, r.lag): r.s for r in al.correlate(rows(0), rows(1), rooms, ["pair", "band"], length).collect()}
    want = {}
    for (p, b), (x, y) in series.items():
        x, y = (np.where((np.arange(len(s)) + b) % 9, s, 0) for s in (x, y))
        for lag in range(71 + 4 * p if p < 2 else 0):
            want[p, b, lag] = sum(x[n] * y[n + lag] for n in range(len(x)) if n + lag < len(y))
    assert set(got) <= set(want) and all(abs(want[k] - got.get(k, 0)) < 1e-9 for k in want)


def test_a_long_series_is_found_and_spread(spark):
    rng = np.random.default_rng(3)
    long = rng.standard_normal(60_000)
    clip = spark.createDataFrame([(1, 0, n, float(x)) for n, x in enumerate(long)], "pair int, band int, n long, x double")
    ref = clip.filter("n >= 31234 and n < 51234").selectExpr("pair", "band", "n - 31234 as n", "x")
    (r,) = al.band_offset(ref, clip, 2048).collect()
    assert r.lag == 31234 and r.best > 10 * r.others


def test_offset_with_gaps_and_nulls(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal(300)
    ref = spark.createDataFrame([(1, n, float(x[n])) for n in range(40, 240) if n % 17] + [(2, 0, 1.0), (3, 5, None)], "pair int, n long, x double")
    clip = spark.createDataFrame([(1, n, float(x[n + 45])) for n in range(0, 200) if n % 13], "pair int, n long, x double")
    got = al.xcorr_offset(ref, clip, 60).collect()
    assert [(r.pair, r.lag) for r in got] == [(1, 45)]
