"""Most frequent values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def modal_value(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Each entity's most frequent value; a tie goes to the higher value."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    return counts.groupBy(*keys).agg(
        F.max_by(value, F.struct("_n", value)).alias("modal"),
        F.max("_n").alias("modal_n"), F.sum("_n").alias("total"),
        F.count("*").alias("n_values"))


def dominant_categories(df: DataFrame, group: str, category: str, n: int = 3) -> DataFrame:
    """The n commonest categories of each group as one line, commonest first.

    The rank filter is pushed before the shuffle, so a group of many categories
    sends at most n rows per task; the list is built from n rows.
    """
    counts = df.groupBy(group, category).agg(F.count("*").alias("_n"))
    order = W.partitionBy(group).orderBy(F.desc("_n"), category)
    top = counts.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= n)
    label = F.concat(F.col(category).cast("string"), F.lit(" ("),
                     F.col("_n").cast("string"), F.lit(")"))
    ranked = F.sort_array(F.collect_list(F.struct("_rank", label.alias("label"))))
    return top.groupBy(group).agg(
        F.concat_ws(", ", F.transform(ranked, lambda r: r["label"])).alias("dominant"))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence, n: int = 1) -> DataFrame:
    """The first n rows of each key in ``order``, numbered by ``rank``."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
