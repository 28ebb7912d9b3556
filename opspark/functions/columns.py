"""Column helpers: pure expressions, no DataFrame needed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Lower bounds of the widening buckets above the unit-wide ones,
# the largest believable fee as a share of the total, the bounds inside which a
# derived fee is accepted, and the null-rate from which a column gets a flag.
BUCKET_EDGES = (20, 30, 50, 100, 200, 500, 1000)
MAX_FEE_SHARE = 0.06
DERIVED_FEE_CAP = 0.15
DERIVED_FEE_TOLERANCE = 0.005
DERIVED_FEE_FLOOR = 0.02
MIN_NULL_RATE = 0.005

__all__ = [
    "BUCKET_EDGES", "MAX_FEE_SHARE", "DERIVED_FEE_CAP", "DERIVED_FEE_TOLERANCE",
    "DERIVED_FEE_FLOOR", "MIN_NULL_RATE",
    "as_col", "finite", "safe_ratio", "floor_ratio", "per_unit", "plausible",
    "widening_bucket", "band", "calendar_flag", "time_parts", "to_cents", "coerce_value",
    "log_target", "invert_log", "small_distinct", "flag_sum", "positive_probability",
]


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c: Column | str) -> Column:
    """The value, or null where it is NaN or an infinity."""
    c = as_col(c)
    inf = F.lit(float("inf"))
    return F.when(~F.isnan(c) & (F.abs(c) != inf), c)


def safe_ratio(x: Column | str, y: Column | str) -> Column:
    """``x / y``, or null unless ``y`` is above zero."""
    x, y = as_col(x), as_col(y)
    return F.when(y > 0, x / y)


def floor_ratio(x: Column | str, y: Column | str, floor: int = 1) -> Column:
    """``x / y`` with the denominator never below ``floor``."""
    return as_col(x) / F.greatest(as_col(y), F.lit(floor))


def per_unit(x: Column | str, unit: Column | str) -> Column:
    """A figure in the transaction's own unit of account."""
    return safe_ratio(x, unit)


def plausible(fee: Column | str, total: Column | str, cap: float = MAX_FEE_SHARE) -> Column:
    """True where a fee is recorded and is at most ``cap`` of the total."""
    fee, total = as_col(fee), as_col(total)
    return fee.isNotNull() & F.coalesce(
        fee <= F.lit(cap) * F.greatest(total, F.lit(0)), F.lit(False))


def widening_bucket(c: Column | str, edges: Sequence[float] = BUCKET_EDGES) -> Column:
    """Whole units up to the first edge, then the lower bound of the edge bracket."""
    c = as_col(c)
    out = F.when(c < edges[0], F.floor(c))
    for low, high in zip(edges, edges[1:]):
        out = out.when(c < high, F.lit(low))
    return out.when(c.isNotNull(), F.lit(edges[-1])).cast("int")


def band(c: Column | str, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """The first label whose cut (descending) lies below the value, else the last."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("one more label than cuts is needed")
    c = as_col(c)
    out = F.when(c > cuts[0], labels[0])
    for cut, label in zip(cuts[1:], labels[1:]):
        out = out.when(c > cut, label)
    return out.otherwise(labels[-1])


def calendar_flag(day: Column | str, days: Sequence[int]) -> Column:
    return as_col(day).isin(list(days))


def time_parts(day: Column | str, time: Column | str) -> dict[str, Column]:
    """Hour, minute of day and minute of the whole period from ``HH:MM:SS`` text."""
    day, time = as_col(day), as_col(time)
    hour = F.substring(time, 1, 2).cast("int")
    minute = hour * 60 + F.substring(time, 4, 2).cast("int")
    return {"hour": hour, "minute_of_day": minute, "minute_key": day * 1440 + minute}


def to_cents(c: Column | str) -> Column:
    """Money as whole cents, so that sums are exact in any order."""
    return F.round(as_col(c) * 100).cast("bigint")


def coerce_value(c: Column | str, kind: str, digits: int = 4) -> Column:
    """One fixed type for a value whose type varies by record; null if it has none.

    Money and rates go through a decimal so that the rounding is the written
    number's, not that of its nearest binary fraction.
    """
    c = as_col(c)
    if kind == "double":
        return c.try_cast(T.DecimalType(38, digits)).cast("double")
    if kind == "int":
        return c.try_cast("double").try_cast("int")
    return c.try_cast(kind)


def log_target(c: Column | str) -> Column:
    return F.log1p(as_col(c))


def invert_log(pred: Column | str, low: float, high: float) -> Column:
    """Back from log scale, first clipped to the range seen in training."""
    return F.expm1(F.least(F.greatest(as_col(pred), F.lit(low)), F.lit(high)))


def small_distinct(c: Column | str) -> Column:
    """Distinct count for a column with a small, closed domain (a level, a tier).

    A set per group keeps the aggregate single-pass; the state is bounded by the
    domain, not by the rows. For an open domain collapse the rows first
    (``distinct_resources``).
    """
    return F.size(F.collect_set(as_col(c)))


def flag_sum(condition: Column) -> Column:
    """How many rows meet a condition; a null condition does not count."""
    return F.sum(F.when(condition, 1).otherwise(0))


def positive_probability(c: Column | str = "probability") -> Column:
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(as_col(c))[1]
