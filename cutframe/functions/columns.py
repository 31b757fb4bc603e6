"""Column helpers for folds inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value evaluated once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def record(**fields: Column) -> Column:
    """A struct of the named columns."""
    return F.struct(*(c.alias(n) for n, c in fields.items()))
