"""Attribute a shared fee to the participants who built the transaction.

Shares come from per-transaction totals joined back, not from a window over the
transaction: the totals are combined map-side, and rows of a transaction that
owns a large part of the table are joined to its one total without a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opspark.functions.columns import flag_sum
from opspark.operators.joins import skew_join
from opspark.operators.scan import HOT_ROWS
from opspark.session import cut, measured

WINDOW_DAYS = 7


def _share(amount, whole, n):
    return F.when(whole > 0, amount / whole).otherwise(F.lit(1.0) / n)


def hot_totals(totals: DataFrame, txn: str, n: str, hot_rows: int) -> DataFrame | None:
    """The transactions of very many rows, from totals that already hold the counts."""
    hot = measured(totals.filter(F.col(n) > hot_rows).select(txn))
    return None if hot.isEmpty() else hot


def contribution_share(df: DataFrame, txn: str, amount: str,
                       hot_rows: int = HOT_ROWS) -> DataFrame:
    """Adds share (of the transaction's total; equal split if that is 0) and n."""
    paid = F.coalesce(F.col(amount), F.lit(0))
    totals = cut(df.groupBy(txn).agg(F.sum(paid).alias("_whole"), F.count("*").alias("n")))
    return (skew_join(df, totals, [txn], hot=hot_totals(totals, txn, "n", hot_rows))
            .withColumn("share", _share(paid, F.col("_whole"), F.col("n"))).drop("_whole"))


# Conditions on ``age``, the days from a transaction back to its site's cutoff.
WINDOWS = {"p": "age >= 0", "w1": f"age BETWEEN 0 AND {WINDOW_DAYS - 1}", "all": "true"}


def attribute_fee(parts: DataFrame, txns: DataFrame, txn: str, keys: Sequence[str], amount: str,
                  fees: Mapping[str, str], whole: str, n: str, day: str, window: DataFrame,
                  site: str = "site", windows: Mapping[str, str] = WINDOWS,
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every fee, in every window, by every split rule, summed per entity in one pass.

    ``txns`` has one row per transaction: site, day, the fees (suffix -> column,
    null where there is none), and the total ``whole`` and row count ``n`` of its
    parts, which are known from building it. Columns, for window W and fee F:
    ``W_fee F`` by contributed share, ``W_fee F _equal`` in equal parts, ``W_rows F``
    (rows whose transaction has the fee), and ``W_rows``, ``W_invested``.
    """
    per_txn = (txns.select(txn, site, day, whole, n, *fees.values())
               .join(measured(window.select(site, "cutoff")), site)
               .withColumn("age", F.col("cutoff") - F.col(day)))
    rows = skew_join(parts.select(txn, *[k for k in keys if k != site],
                                  F.coalesce(amount, F.lit(0)).alias("_paid")),
                     per_txn, [txn], hot=hot_totals(txns, txn, n, hot_rows))
    rules = {"": _share(F.col("_paid"), F.col(whole), F.col(n)), "_equal": F.lit(1.0) / F.col(n)}
    sums = []
    for w, condition in windows.items():
        here = F.expr(condition)
        sums += [flag_sum(here).alias(f"{w}_rows"),
                 F.sum(F.when(here, F.col("_paid"))).alias(f"{w}_invested")]
        for name, fee in fees.items():
            value = F.coalesce(fee, F.lit(0))
            sums += [F.sum(F.when(here, value * rule)).alias(f"{w}_fee{name}{suffix}")
                     for suffix, rule in rules.items()]
            if name:
                sums.append(flag_sum(here & F.col(fee).isNotNull()).alias(f"{w}_rows{name}"))
    return rows.groupBy(*keys).agg(*sums)
