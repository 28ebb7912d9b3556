"""Roll-ups, pivots, pooled rates, exact percentiles and group profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opspark.functions.columns import as_col, flag_sum
from opspark.operators.scan import HOT_ROWS, Measure, running
from opspark.operators.selection import ROOM, column_percentiles
from opspark.session import measured


def rollup(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """One row per key, one aggregate per name."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def child_rollup(df: DataFrame, key: str, amount: str, value: str) -> DataFrame:
    """Child rows of a transaction: count, mean and least amount, recorded values, their sum."""
    return rollup(df, [key], {
        "n_rows": F.count("*"), "avg_amount": F.avg(amount), "min_amount": F.min(amount),
        "n_values": F.count(value), "sum_values": F.sum(value)})


def pivot_counts(df: DataFrame, row: Sequence[str] | str, col: str,
                 values: Sequence) -> DataFrame:
    """Counts per row key and fixed column value, zero where there are none."""
    keys = [row] if isinstance(row, str) else list(row)
    return df.groupBy(*keys).pivot(col, list(values)).count().na.fill(
        0, [str(v) for v in values])


def pivot_mean(df: DataFrame, row: Sequence[str] | str, col: str, values: Sequence,
               value: Column | str) -> DataFrame:
    keys = [row] if isinstance(row, str) else list(row)
    return df.groupBy(*keys).pivot(col, list(values)).agg(F.avg(as_col(value)))


def outcome_matrix(df: DataFrame, row: str, segment: str, segments: Sequence,
                   outcome: Column | str) -> DataFrame:
    """Mean outcome for every row value and segment."""
    return pivot_mean(df, row, segment, segments, outcome)


def pooled_rate(df: DataFrame, rates: Mapping[str, str], n: str,
                by: Sequence[str] = ()) -> DataFrame:
    """Rates weighted by their own row counts: the rate over all rows together."""
    weight = F.col(n)
    out = df.groupBy(*by).agg(
        F.sum(weight).alias("n"),
        *[F.sum(F.col(c) * weight).alias(name) for name, c in rates.items()])
    return out.withColumns({name: F.when(F.col("n") > 0, F.col(name) / F.col("n"))
                            for name in rates})


def group_percentiles(df: DataFrame, keys: Sequence[str], value: str,
                      points: Mapping[str, float], exact: bool = True,
                      accuracy: int = 1_000_000, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Discrete percentiles per group: the least value covering a share p of the rows.

    The exact form counts equal values first (so repeated values never travel
    twice), then scans the counts in value order; a group of any size is spread
    over tasks. ``exact=False`` uses Spark's mergeable sketch instead.
    """
    keys = list(keys)
    if not exact:
        return df.groupBy(*keys).agg(*[
            F.percentile_approx(value, F.lit(p), F.lit(accuracy)).alias(n)
            for n, p in points.items()])
    counts = (df.filter(F.col(value).isNotNull()).groupBy(*keys, value)
              .agg(F.count("*").alias("_n")))
    scanned = running(counts, [value], [
        Measure("_upto", "sum", "_n"), Measure("_all", "sum", "_n", total=True)],
        by=keys, hot_rows=hot_rows)
    def rank(p: float) -> Column:
        """ceil(p * n), at least 1, in whole numbers."""
        share = Fraction(p).limit_denominator(10**6)
        return F.greatest(F.expr(f"({share.numerator} * _all + {share.denominator - 1}) "
                                 f"div {share.denominator}"), F.lit(1))

    return scanned.groupBy(*keys).agg(*[
        F.min(F.when(F.col("_upto") >= rank(p), F.col(value))).alias(n)
        for n, p in points.items()])


def summary_stats(df: DataFrame, cols: Sequence[str], room: int = ROOM) -> DataFrame:
    """min, quartiles and max of several columns, one row per column; selected, not sorted."""
    return column_percentiles(df, cols, {
        "min": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "max": 1.0}, room)


def segment_profile(df: DataFrame, segment: str, cols: Sequence[str],
                    outcome: str | None = None, signed: str | None = None) -> DataFrame:
    """Segment means in original units, share of all rows, share with a negative figure.

    A missing figure counts as not negative; ``n_{signed}`` says how many have one.
    """
    aggs = [F.count("*").alias("n"), *[F.avg(c).alias(f"avg_{c}") for c in cols]]
    if outcome:
        aggs.append(F.avg(outcome).alias("outcome_rate"))
    if signed:
        aggs += [F.avg(F.when(F.col(signed) < 0, 1).otherwise(0)).alias("share_negative"),
                 F.count(signed).alias(f"n_{signed}")]
    table = measured(df.groupBy(segment).agg(*aggs))
    total = table.agg(F.sum("n").alias("t")).scalar()
    return table.withColumn("share", F.col("n") / total)


def slice_table(df: DataFrame, by: Sequence[str] | str, risk: str, value: str, loss: str,
                label: str, measured_value: str | None = None,
                threshold: float = 0.5) -> DataFrame:
    """Who holds the value at risk, cut by any dimension."""
    keys = [by] if isinstance(by, str) else list(by)
    aggs = [F.count("*").alias("entities"),
            flag_sum(F.col(risk) >= threshold).alias("flagged"),
            F.sum(label).alias("positives"), F.sum(value).alias("value"),
            F.sum(loss).alias("expected_loss"), F.avg(risk).alias("mean_risk")]
    if measured_value:
        aggs.append(F.sum(measured_value).alias("measured_value"))
    table = measured(df.groupBy(*keys).agg(*aggs))
    total = table.agg(F.sum("expected_loss").alias("t")).scalar()
    out = (table.withColumn("positive_rate", F.col("positives") / F.col("entities"))
           .withColumn("share_of_loss", F.when(total != 0, F.col("expected_loss") / total))
           .withColumn("loss_rate", F.when(F.col("value") != 0,
                                           F.col("expected_loss") / F.col("value")))
           .withColumn("value_per_entity", F.col("value") / F.col("entities")))
    if measured_value:
        out = out.withColumn("measured_share", F.when(
            F.col("value") != 0, F.col("measured_value") / F.col("value")))
    return out
