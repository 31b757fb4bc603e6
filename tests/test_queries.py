"""Every registered query with a SQL twin gives the twin's rows."""

from __future__ import annotations

import math

import duckdb
import pytest

from cutframe import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture
def duck(sf_dir, tmp_path):
    """A database of its own for each test, so that a failure of one stays with it; bounded, as Spark's JVM runs beside it."""
    with duckdb.connect(config={"threads": 4, "memory_limit": "4GB", "temp_directory": str(tmp_path)}) as c:
        for t in TABLES.split():
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
        yield c


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else x + 0.0
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return x


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, sf_dir, duck, name):
    df = registry.queries()[name](spark, sf_dir)
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    want = duck.sql(registry.oracle_sql()[name])
    assert sorted(want.columns) == names
    at = [want.columns.index(c) for c in names]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)
