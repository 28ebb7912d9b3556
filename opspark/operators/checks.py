"""Reconciliation checks. Each returns check, got, want, ok."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opspark.functions.columns import as_col


def _close(got: Column, want: Column, tol: float) -> Column:
    return F.coalesce(F.abs(got - want) <= F.lit(tol) * F.greatest(
        F.abs(want).cast("double"), F.lit(1.0)), F.lit(False))


def _row(df: DataFrame, name: str, got: Column, want: Column, tol: float = 0.0) -> DataFrame:
    one = df.agg(got.alias("got"), want.alias("want"))
    return one.select(F.lit(name).alias("check"), "got", "want",
                      _close(F.col("got"), F.col("want"), tol).alias("ok"))


def check_zero_sum(parts: DataFrame, txns: DataFrame, txn: str, net: str, fee: str,
                   tol: float = 1e-6) -> DataFrame:
    """Results sum to minus the fee: transactions that break it, and the grand totals."""
    per = parts.groupBy(txn).agg(F.sum(net).alias("_net"))
    both = txns.select(txn, fee).join(per, txn)
    one = both.agg(
        F.sum(F.when(~_close(F.col("_net"), -F.col(fee), tol), 1).otherwise(0)).alias("bad"),
        F.sum("_net").alias("net"), (-F.sum(fee)).alias("fee"))
    rows = F.array(
        F.struct(F.lit("transactions off").alias("check"),
                 F.col("bad").cast("double").alias("got"), F.lit(0.0).alias("want")),
        F.struct(F.lit("total").alias("check"), F.col("net").cast("double").alias("got"),
                 F.col("fee").cast("double").alias("want")))
    return (one.select(F.explode(rows).alias("r")).select("r.*")
            .withColumn("ok", _close(F.col("got"), F.col("want"), tol)))


def check_attribution(df: DataFrame, contributed: str = "all_fee",
                      equal: str = "all_fee_equal", tol: float = 1e-6) -> DataFrame:
    """Two ways to split one fee have one total."""
    return _row(df, "contributed = equal split", F.sum(contributed), F.sum(equal), tol)


def check_counts(a: DataFrame, b: DataFrame, keys: Sequence[str],
                 cols: Mapping[str, str]) -> DataFrame:
    """Figures of one entity from two independent builds: how many entities differ.

    ``cols`` maps a column of a to its twin in b. An entity missing on one side
    differs in every column.
    """
    left = a.select(*keys, *[F.col(c).alias(f"_a_{c}") for c in cols])
    right = b.select(*keys, *[F.col(o).alias(f"_b_{c}") for c, o in cols.items()])
    both = left.join(right, list(keys), "full")
    one = both.agg(*[F.sum(F.when(F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}")), 0)
                           .otherwise(1)).cast("bigint").alias(c) for c in cols])
    return (one.unpivot([], list(cols), "check", "got")
            .withColumn("want", F.lit(0).cast("bigint"))
            .withColumn("ok", F.coalesce(F.col("got"), F.lit(0)) == 0))


def check_reconcile(published: DataFrame, recomputed: DataFrame, keys: Sequence[str],
                    value: str, tol: float = 1e-6) -> DataFrame:
    """Published totals against recomputed ones, slice by slice."""
    p = published.select(*keys, F.col(value).alias("want"))
    r = recomputed.select(*keys, F.col(value).alias("got"))
    return (p.join(r, list(keys), "full")
            .withColumn("check", F.concat_ws(":", *[F.col(k).cast("string") for k in keys]))
            .select("check", "got", "want", _close(F.col("got"), F.col("want"), tol).alias("ok")))


def check_windows(a: DataFrame, b: DataFrame, site: str = "site",
                  cols: Sequence[str] = ("site_last_day", "cutoff")) -> DataFrame:
    """Two builds describe the same weeks."""
    return check_counts(a, b, [site], {c: c for c in cols})


def check_split(df: DataFrame, prior: str, label_window: str,
                rows: Column | str | int) -> DataFrame:
    """Prior rows plus label rows are all the rows."""
    want = F.lit(rows) if isinstance(rows, int) else as_col(rows)
    one = df.agg(F.sum(F.col(prior) + F.col(label_window)).alias("got"))
    return one.select(F.lit("prior + label").alias("check"), "got",
                      want.cast("bigint").alias("want"),
                      (F.col("got") == want).alias("ok"))
