"""Data quality: classify, guard, flag, profile and quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opspark.functions.columns import MIN_NULL_RATE, as_col, finite, flag_sum, plausible
from opspark.session import measured


def quality_status(df: DataFrame, fee: str, n_values: str, sum_values: str,
                   name_no_rows: bool = False) -> DataFrame:
    """Classify how far a transaction's money can be trusted.

    ok (a fee was derived) > absent (no values at all) > all_zero > unreconciled.
    A transaction without child rows has null counts and falls through to
    unreconciled, unless ``name_no_rows`` asks for its own class.
    """
    status = F.when(F.col(fee).isNotNull(), "ok")
    if name_no_rows:
        status = status.when(F.col(n_values).isNull(), "no_rows")
    status = (status.when(F.col(n_values) == 0, "absent")
              .when(F.col(sum_values) == 0, "all_zero").otherwise("unreconciled"))
    return df.withColumn("status", status).withColumn("usable", F.col("status") == "ok")


def quarantine(df: DataFrame,
               rules: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """(good, bad): a row is bad for the first rule that holds; bad rows say why.

    Neither part is lost: together they are the input.
    """
    reason = F.lit(None).cast("string")
    for name, rule in reversed(list(rules)):
        reason = F.when(F.coalesce(rule, F.lit(False)), name).otherwise(reason)
    tagged = df.withColumn("reason", reason)
    return (tagged.filter(F.col("reason").isNull()).drop("reason"),
            tagged.filter(F.col("reason").isNotNull()))


def quarantine_counts(bad: DataFrame) -> DataFrame:
    return bad.groupBy("reason").agg(F.count("*").alias("n"))


def guard_finite(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: finite(c) for c in cols})


def count_non_finite(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: how many values are NaN or infinite."""
    one = df.agg(*[flag_sum(F.col(c).isNotNull() & finite(c).isNull()).alias(c) for c in cols])
    return one.unpivot([], list(cols), "column", "hits").select(
        "column", F.coalesce("hits", F.lit(0)).cast("bigint").alias("hits"))


def recorded_flags(df: DataFrame, site: str, col: str, min_distinct: int = 2) -> DataFrame:
    """Per site: does the column really vary there, or is it a filler value?"""
    return df.groupBy(site).agg((F.countDistinct(col) >= min_distinct).alias("recorded"))


def null_unrecorded(df: DataFrame, flags: DataFrame, site: str,
                    cols: Sequence[str], flag: str = "recorded") -> DataFrame:
    """Null the derived columns of sites that do not record the field; keep the flag."""
    out = df.join(measured(flags), site, "left").withColumn(
        flag, F.coalesce(F.col(flag), F.lit(False)))
    return out.withColumns({c: F.when(F.col(flag), F.col(c)) for c in cols})


def recorded_share(df: DataFrame, site: str, flag: str, minimum: float = 0.5) -> DataFrame:
    """Sites that record a field for more than ``minimum`` of their entities."""
    return (df.groupBy(site).agg(F.avg(F.col(flag).cast("int")).alias("share"))
            .filter(F.col("share") > minimum))


def null_indicators(df: DataFrame, cols: Sequence[str],
                    min_rate: float = MIN_NULL_RATE) -> tuple[DataFrame, list[str]]:
    """``df`` with a 0/1 column beside each column that has gaps worth a feature.

    One pass counts rows and known values; only columns whose share of gaps is
    over ``min_rate`` get an indicator.
    """
    seen = df.select(F.count(F.lit(1)), *map(F.count, cols)).first()
    flags = {f"{c}_missing": F.when(F.isnull(c), 1.0).otherwise(0.0)
             for c, known in zip(cols, seen[1:]) if seen[0] - known > min_rate * seen[0]}
    return df.select("*", *[flag.alias(name) for name, flag in flags.items()]), list(flags)


def null_profile(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """One row per column with its null rate; order by rate to read it."""
    cols = [c for c in df.columns if c not in set(exclude)]
    one = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in cols])
    return one.unpivot([], cols, "column", "rate")


def levels_of(df: DataFrame, col: str) -> list[str]:
    """The known values of a column in order, as a fitted indexer holds them."""
    from pyspark.ml.feature import StringIndexer

    text = df.select(F.col(col).cast("string").alias(col))
    return list(StringIndexer(inputCol=col, outputCol="_i", handleInvalid="skip",
                              stringOrderType="alphabetAsc").fit(text).labels)


def one_hot(df: DataFrame, col: str, reference: str, prefix: str | None = None,
            levels: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    """A 0/1 column for each level but the reference; unknown values are 0 in all.

    ``levels``, where the caller knows them, saves the pass that finds them.
    """
    shown = [v for v in (levels or levels_of(df, col)) if v != reference]
    value = F.coalesce(F.col(col).cast("string"), F.lit(reference))
    columns = {f"{prefix or col}_{v}": F.when(value == v, 1.0).otherwise(0.0) for v in shown}
    return df.withColumns(columns), list(columns)


def coverage_by_site(df: DataFrame, site: str, fee: str, total: str, unit: str,
                     cap: float = 0.06, minimum: float = 0.01) -> DataFrame:
    """Where a fee can be measured at all.

    fee and total are in the transaction's unit; money is fee times unit.
    """
    money = F.col(fee) * F.col(unit)
    # Every row is one of: no figure, a figure beyond belief, a plausible one.
    kinds = {"figure": F.col(fee).isNotNull(), "good": plausible(fee, total, cap)}
    seen = df.select(site, *[F.when(c, 1).alias(f"_{k}") for k, c in kinds.items()],
                     *[F.when(c, money).alias(f"_{k}_money") for k, c in kinds.items()])
    names = {"figure": ("with_figure", "money_with_figure"), "good": ("plausible", "money_plausible")}
    sums = [F.count("*").alias("rows")]
    for k, (count, amount) in names.items():
        sums += [F.count(f"_{k}").alias(count),
                 F.coalesce(F.sum(f"_{k}_money"), F.lit(0)).alias(amount)]
    share = F.col("plausible") / F.col("rows")
    return seen.groupBy(site).agg(*sums).select(
        "*", (F.col("money_with_figure") - F.col("money_plausible")).alias("money_dropped"),
        share.alias("coverage"), (share < minimum).alias("excluded"))


def class_balance(df: DataFrame, keys: Sequence[str], label: str,
                  means: Sequence[str] = ()) -> DataFrame:
    """Rows, positives, prevalence and feature means per group."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"), F.sum(label).alias("positives"),
        F.avg(label).alias("prevalence"), *[F.avg(m).alias(f"mean_{m}") for m in means])


def hits(condition: Column | str) -> Column:
    return flag_sum(as_col(condition))
