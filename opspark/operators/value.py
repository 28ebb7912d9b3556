"""Value at risk: expected loss, headline totals, sensitivities."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opspark.functions.columns import as_col, flag_sum, safe_ratio

AT_RISK = 0.5
MIN_OBSERVED = 20


def expected_loss(df: DataFrame, risk: str, value: str, out: str = "expected_loss") -> DataFrame:
    """Risk times value; an entity without value loses nothing."""
    return df.withColumn(out, F.col(risk) * F.coalesce(F.col(value), F.lit(0)))


def naive_value(df: DataFrame, fee_observed: str, n_observed: str, volume: str,
                min_n: int = MIN_OBSERVED, out: str = "naive_value") -> DataFrame:
    """An entity's own observed rate scaled to its volume, kept to show its bias.

    Null below ``min_n`` observed rows.
    """
    rate = F.col(fee_observed) / F.col(n_observed) * 100
    return df.withColumn(out, F.when(F.col(n_observed) >= F.lit(max(min_n, 1)),
                                     rate * F.col(volume) / 100))


def headline(df: DataFrame, risk: str, value: str, measured_value: str, loss: str,
             threshold: float = AT_RISK) -> DataFrame:
    """The one-row summary of the whole table."""
    flagged = F.col(risk) >= threshold
    return (df.agg(
        F.count("*").alias("entities"), F.sum(value).alias("value"),
        F.sum(measured_value).alias("measured_value"), F.sum(loss).alias("expected_loss"),
        flag_sum(flagged).alias("flagged"),
        F.coalesce(F.sum(F.when(flagged, F.col(value))), F.lit(0)).alias("flagged_value"))
        .withColumn("measured_share", safe_ratio("measured_value", "value"))
        .withColumn("loss_share", safe_ratio("expected_loss", "value")))


def sensitivity(df: DataFrame,
                variants: Mapping[str, tuple[Column | None, Column | str]]) -> DataFrame:
    """Each variant's total beside the first one's: (filter or None, amount) by name."""
    names = list(variants)
    one = df.agg(*[F.struct(
        F.count(F.when(keep if keep is not None else F.lit(True), 1)).alias("entities"),
        F.sum(F.when(keep if keep is not None else F.lit(True), as_col(amount))).alias("total"))
        .alias(n) for n, (keep, amount) in variants.items()])
    base = F.col("_first")
    return (one.withColumn("_first", F.col(f"`{names[0]}`.total"))
            .unpivot(["_first"], names, "variant", "s").select("variant", "_first", "s.*")
            .withColumn("vs_first", F.when(base != 0, F.col("total") / base)).drop("_first"))
