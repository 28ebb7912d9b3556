"""Running totals that no single task has to hold.

A window without a partition key, or with one key that owns a large part of the
rows, puts that whole group into one task. ``running`` gives the same columns as
such a window, and keeps every task bounded:

* Groups of ordinary size use a plain window: one shuffle on the key.
* A group above ``hot_rows`` (and every ungrouped scan) is range-partitioned on
  its order into blocks. Each block is scanned on its own, the blocks' totals
  (one row per block and group) are scanned to give what precedes each block,
  and the two are put together. Sum, count, max, min and last are all
  associative, so the result is exactly the window's.

The order columns have to identify a row inside its group: add a key to break
ties. Rows of one order value then spread over blocks too, however many tie.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opspark.functions.columns import as_col
from opspark.session import cut, measured

# A group above HOT_ROWS takes the block form; blocks are to hold about BLOCK_ROWS.
# Both are plan parameters: rows are the same on either side of them.
HOT_ROWS = 2_000_000
BLOCK_ROWS = 2_000_000
BLOCK = "_block"


@dataclass(frozen=True)
class Measure:
    """One running column.

    how: count, sum, max, min, last (last value that is not null).
    inclusive: whether the current row is part of its own figure.
    total: the whole group's figure on every row instead of a running one.
    """

    name: str
    how: str
    value: Column | str | None = None
    inclusive: bool = True
    total: bool = False

    def column(self) -> Column:
        return F.lit(1) if self.value is None else as_col(self.value)


def position(name: str = "position") -> Measure:
    """Row number, starting at 1."""
    return Measure(name, "count")


def _sort(order: Sequence[Column | str]) -> list[Column]:
    return [as_col(o) for o in order]


def _agg(m: Measure, order_key: Column | None = None) -> Column:
    c = m.column()
    if m.how == "count":
        return F.count(c)
    if m.how == "last":
        return F.max_by(c, F.when(c.isNotNull(), order_key)) if order_key is not None \
            else F.last(c, ignorenulls=True)
    return {"sum": F.sum, "max": F.max, "min": F.min}[m.how](c)


def _combine(m: Measure, before: Column, here: Column) -> Column:
    if m.how in ("sum", "count"):
        return F.when(before.isNull() & here.isNull(), F.lit(None)).otherwise(
            F.coalesce(before, F.lit(0)) + F.coalesce(here, F.lit(0)))
    if m.how == "max":
        return F.greatest(before, here)
    if m.how == "min":
        return F.least(before, here)
    return F.coalesce(here, before)


def _frame(w, inclusive: bool):
    return w.rowsBetween(W.unboundedPreceding, W.currentRow if inclusive else -1)


def windowed(df: DataFrame, by: Sequence[str], order: Sequence[Column | str],
             measures: Sequence[Measure]) -> DataFrame:
    """The plain form: one window per group."""
    ordered = W.partitionBy(*by).orderBy(*_sort(order))
    whole = W.partitionBy(*by)
    return df.select("*", *[
        _agg(m).over(whole if m.total else _frame(ordered, m.inclusive)).alias(m.name)
        for m in measures])


def blocks_for(rows: int, df: DataFrame) -> int | None:
    """Blocks that keep each near BLOCK_ROWS, or None where the session's partitions do."""
    needed = -(-rows // BLOCK_ROWS)
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return needed if needed > usual else None


def blocked(df: DataFrame, by: Sequence[str], order: Sequence[Column | str],
            measures: Sequence[Measure], blocks: int | None = None) -> DataFrame:
    """The two-level form: scan inside range blocks, then carry between blocks."""
    by, sort = list(by), _sort(order)
    # Without a number adaptive execution sizes the blocks to the data, joining
    # only neighbours, so they stay in order; beyond what its shuffle partitions
    # can hold, the row count sets the number. The block number is data from here
    # on: it is read back, never recomputed.
    blocks = blocks or blocks_for(df.count(), df)
    ranges = [blocks] if blocks else []
    placed = cut(df.repartitionByRange(*ranges, *[F.col(b) for b in by], *sort)
                   .withColumn(BLOCK, F.spark_partition_id()))

    keys = [BLOCK, *by]
    local = W.partitionBy(*keys).orderBy(*sort)
    running_m = [m for m in measures if not m.total]
    inside = placed.select("*", *[
        _agg(m).over(_frame(local, m.inclusive)).alias(f"_in_{m.name}") for m in running_m])

    if any(m.how == "last" for m in measures):
        if any(not isinstance(o, str) for o in order):
            raise ValueError("a 'last' measure needs plain ascending order columns")
        order_key = F.struct(*order)
    else:
        order_key = None
    sums = placed.groupBy(*keys).agg(*[_agg(m, order_key).alias(m.name) for m in measures])

    # At most one row per block inside each group: a small window.
    earlier = _frame(W.partitionBy(*by).orderBy(BLOCK), inclusive=False)
    whole = W.partitionBy(*by)

    def merged(m: Measure) -> Column:
        how = "sum" if m.how == "count" else m.how
        part = replace(m, how=how, value=m.name)
        return _agg(part).over(whole if m.total else earlier).alias(f"_pre_{m.name}")

    carry = measured(sums.select(*keys, *[merged(m) for m in measures]))
    carry = carry.select(*[F.col(k).alias(f"_c_{k}") for k in keys],
                         *[f"_pre_{m.name}" for m in measures])
    on = F.col(BLOCK) == F.col(f"_c_{BLOCK}")
    for k in by:
        on = on & F.col(k).eqNullSafe(F.col(f"_c_{k}"))
    both = inside.join(carry, on)
    return both.select(*df.columns, *[
        (F.col(f"_pre_{m.name}") if m.total
         else _combine(m, F.col(f"_pre_{m.name}"), F.col(f"_in_{m.name}"))).alias(m.name)
        for m in measures])


def hot_keys(df: DataFrame, by: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The keys owning more than ``hot_rows`` rows, or None if there are none.

    There are at most rows/hot_rows of them, whatever the data looks like.
    """
    hot = measured(df.groupBy(*by).count().filter(F.col("count") > hot_rows).select(*by))
    if hot.isEmpty():
        hot.unpersist()
        return None
    return hot


def split_hot(df: DataFrame, by: Sequence[str],
              hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of hot keys); null keys match like any other."""
    right = hot.select(*[F.col(b).alias(f"_h_{b}") for b in by])
    on = F.lit(True)
    for b in by:
        on = on & F.col(b).eqNullSafe(F.col(f"_h_{b}"))
    return df.join(right, on, "left_anti"), df.join(right, on, "left_semi")


def running(df: DataFrame, order: Sequence[Column | str], measures: Sequence[Measure],
            by: Sequence[str] = (), hot_rows: int = HOT_ROWS,
            blocks: int | None = None) -> DataFrame:
    """``df`` with one column per measure, scanned in ``order`` inside each ``by`` group."""
    by = list(by)
    if not by:
        return blocked(df, [], order, measures, blocks)
    hot = hot_keys(df, by, hot_rows)
    if hot is None:
        return windowed(df, by, order, measures)
    cold_rows, hot_part = split_hot(df, by, hot)
    return windowed(cold_rows, by, order, measures).unionByName(
        blocked(hot_part, by, order, measures, blocks))
