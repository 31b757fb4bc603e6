"""Registered queries: operators bound to the tables, each with a SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.views import cte

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, views: str = "", sql: str | None = None):
    """Register a function of (spark, sf_dir); sql may use the named views."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = cte(views) + sql
        return f

    return add
