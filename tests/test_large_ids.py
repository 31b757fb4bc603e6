"""Queries that read a candidate's number from its id take all its digits: events numbered past 999999."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from cutframe import registry

QUERIES = [
    "cnd11_recommend",
    "evd12_validate_decisions",
    "evd14_materialize_chain",
    "evd20_artifact_diff",
    "tml12_validate_promotions",
]


@pytest.fixture(scope="module")
def large_ids(spark, sf_dir, tmp_path_factory):
    d = tmp_path_factory.mktemp("ids")
    spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("event_id", F.col("event_id") + 999_500).write.parquet(f"{d}/events.parquet")
    return d


@pytest.mark.parametrize("name", QUERIES)
def test_numbers_of_seven_digits(spark, large_ids, name):
    df = registry.queries()[name](spark, str(large_ids))
    names = sorted(df.columns)
    with duckdb.connect(config={"threads": 4, "memory_limit": "2GB"}) as c:
        c.execute(f"CREATE VIEW events AS SELECT * FROM '{large_ids}/events.parquet/*.parquet'")
        want = c.sql(registry.oracle_sql()[name])
        at = [want.columns.index(n) for n in names]
        rows = [tuple(r[i] for i in at) for r in want.fetchall()]
    assert sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr) == sorted(rows, key=repr)
