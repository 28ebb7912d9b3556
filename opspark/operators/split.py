"""Train/test folds and population filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opspark.functions.keys import hash_percent
from opspark.session import measured

MIN_ROWS = 100


def hash_fold(df: DataFrame, keys: Sequence[str], seed: int = 42, percent: int = 25) -> DataFrame:
    """fold = test for ``percent`` of the keys, always the same ones."""
    return df.withColumn("fold", F.when(hash_percent(keys, seed) < percent, "test")
                         .otherwise("train"))


def time_split(df: DataFrame, site: str, day: str, days: int = 4) -> DataFrame:
    """fold = test for the last ``days`` days of each site's own record."""
    last = measured(df.groupBy(site).agg(F.max(day).alias("_last")))
    return (df.join(last, site)
            .withColumn("fold", F.when(F.col(day) > F.col("_last") - days, "test")
                        .otherwise("train")).drop("_last"))


def random_split(df: DataFrame, test: float = 0.2, seed: int = 42) -> list[DataFrame]:
    return df.randomSplit([1 - test, test], seed=seed)


def population(df: DataFrame, prior: str, minimum: int = MIN_ROWS) -> DataFrame:
    """Entities with enough activity before the cutoff: a rule usable on that day."""
    return df.filter(F.col(prior) >= minimum)


def population_report(df: DataFrame, prior: str, label_window: str,
                      minimum: int = MIN_ROWS) -> DataFrame:
    """How many the honest rule keeps, and how many more a lifetime rule would.

    The difference can only be kept by looking into the window being predicted.
    """
    p, lab = F.col(prior), F.col(label_window)
    return (df.filter(p > 0).agg(
        F.count("*").alias("seen"),
        F.sum((p >= minimum).cast("bigint")).alias("kept"),
        F.sum((p + lab >= minimum).cast("bigint")).alias("kept_by_lifetime"))
        .withColumn("leaked", F.col("kept_by_lifetime") - F.col("kept")))
