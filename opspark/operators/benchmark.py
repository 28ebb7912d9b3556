"""Group benchmarks: percentiles, rates, mean-median gap, correlation, counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opspark.operators.rollup import group_percentiles


def salary_benchmark(df: DataFrame, key: str, value: str, exact: bool = True) -> DataFrame:
    """n, mean, quartiles and interquartile range per group."""
    means = df.groupBy(key).agg(F.count("*").alias("n"), F.avg(value).alias("mean"))
    quart = group_percentiles(df, [key], value, {"p25": 0.25, "median": 0.5, "p75": 0.75}, exact)
    return means.join(quart, key).withColumn("iqr", F.col("p75") - F.col("p25"))


def rates(df: DataFrame, keys: Sequence[str], placed: str, employed: str) -> DataFrame:
    """Cohort, two rates in percent, and the complement of the second."""
    return (df.groupBy(*keys).agg(
        F.count("*").alias("cohort"),
        (F.avg(F.col(employed).cast("int")) * 100).alias("employed_pct"),
        (F.avg(F.col(placed).cast("int")) * 100).alias("placed_pct"))
        .withColumn("available_pct", 100 - F.col("placed_pct")))


def mean_median_gap(df: DataFrame, key: str, value: str, min_n: int = 40,
                    limit: int | None = None) -> DataFrame:
    """Groups of more than ``min_n`` rows by how far the mean lies above the median."""
    out = (salary_benchmark(df, key, value).filter(F.col("n") > min_n)
           .select(key, "n", "mean", "median", (F.col("mean") - F.col("median")).alias("gap")))
    return out.orderBy(F.desc("gap"), key).limit(limit) if limit else out


def mean_median_gap_sql(df: DataFrame, key: str, value: str, min_n: int = 40,
                        limit: int = 8) -> DataFrame:
    """The same report as SQL text; the median is exact, from counts of equal values."""
    return df.sparkSession.sql(f"""
        WITH c AS (SELECT {key} AS k, {value} AS v, count(*) AS n FROM {{rows}} GROUP BY 1, 2),
        u AS (SELECT k, v, sum(n) OVER (PARTITION BY k ORDER BY v) AS upto,
                     sum(n) OVER (PARTITION BY k) AS total FROM c WHERE v IS NOT NULL),
        m AS (SELECT k, min(v) AS median FROM u WHERE 2 * upto >= total GROUP BY k),
        s AS (SELECT {key} AS k, count(*) AS n, avg({value}) AS mean FROM {{rows}} GROUP BY 1)
        SELECT s.k AS {key}, n, mean, median, mean - median AS gap
        FROM s JOIN m ON s.k = m.k WHERE n > {int(min_n)}
        ORDER BY gap DESC, 1 LIMIT {int(limit)}""", rows=df)


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Pearson correlation of each pair, one row per pair, in one pass."""
    one = df.agg(*[F.corr(a, b).alias(f"{a}~{b}") for a, b in pairs])
    return one.unpivot([], [f"{a}~{b}" for a, b in pairs], "pair", "corr")


def reduce_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per key: map-side partial counts, then one reduce."""
    return df.groupBy(key).agg(F.count("*").alias("n"))


def reduce_mean(df: DataFrame, key: str, value: str) -> DataFrame:
    """Mean per key carried as a (sum, count) pair up to the last step."""
    pair = df.groupBy(key).agg(F.sum(value).alias("_s"), F.count(value).alias("n"))
    return pair.select(key, "n", F.when(F.col("n") > 0, F.col("_s") / F.col("n")).alias("mean"))


def filter_group_total_sort(df: DataFrame, predicate: Column, key: str,
                            value: str) -> DataFrame:
    """The four-verb dataflow: filter, group, total, sort."""
    return (df.filter(predicate).groupBy(key)
            .agg(F.count("*").alias("n"), F.sum(value).alias("total"))
            .orderBy(F.desc("total"), key))


def lognormal_fit(df: DataFrame, keys: Sequence[str], value: str,
                  hot_rows: int | None = None) -> DataFrame:
    """Log-normal parameters of each group from its quartiles.

    1.35 is the interquartile range of a standard normal; a group without spread
    gets sigma 0.10, and no sigma goes below 0.05.
    """
    extra = {} if hot_rows is None else {"hot_rows": hot_rows}
    q = group_percentiles(df, keys, value, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, **extra)
    wide = (F.col("p75") > F.col("p25")) & (F.col("p25") > 0)
    sigma = F.when(wide, (F.ln("p75") - F.ln("p25")) / 1.35).otherwise(0.10)
    return q.select(*keys, F.ln(F.greatest(F.col("p50"), F.lit(1))).alias("mu"),
                    F.greatest(sigma, F.lit(0.05)).alias("sigma"))


def spread(df: DataFrame, key: str, value: str) -> DataFrame:
    """The best and the worst group and their ratio; ties go to the lower key."""
    one = df.groupBy(value).agg(F.min(key).alias("_k")).agg(
        F.max_by("_k", value).alias("best"), F.min_by("_k", value).alias("worst"),
        F.max(value).alias("high"), F.min(value).alias("low"))
    return one.withColumn("ratio", F.when(F.col("low") != 0, F.col("high") / F.col("low")))
