"""Named queries over the given tables, each beside the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query; without ``sql`` only its rows can be checked."""
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn
    return add


def fixed(c: Column | str, scale: float = 1e6) -> Column:
    """A float as a whole number of 1/scale.

    Sums of doubles depend on their order in the last digits; a scaled whole
    number does not, so two engines can be compared. The offset keeps common
    fractions (halves, thirds, tenths) away from the edge being cut.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c * scale + 0.37).cast("bigint")


def fixed_sql(expr: str, scale: float = 1e6) -> str:
    return f"CAST(floor(({expr}) * {scale} + 0.37) AS BIGINT)"
