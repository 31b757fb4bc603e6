"""All registered queries of the timeline operators with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import plans
from .plans import activity, align, audit, candidates, colour, evidence, jobs, library, music, qc, signals, timeline, validate, windows  # noqa: F401  each registers its queries

FLAGSHIP = "mus06_quantize"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(plans.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(plans.ORACLES)
