"""How many resources an entity uses at once, and in all.

Rows are collapsed to one per (entity, bucket, resource) before anything is
counted. The collapse is a map-side combined aggregate on a key much finer than
the entity, so a very active entity is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SENTINEL = "∅"


def distinct_with_sentinel(df: DataFrame, keys: Sequence[str], bucket: str,
                           resource: str, sentinel: str = SENTINEL) -> DataFrame:
    """Distinct (entity, bucket, resource); an unknown resource is kept as the sentinel."""
    return df.select(*keys, bucket, F.coalesce(
        F.col(resource).cast("string"), F.lit(sentinel)).alias(resource)).distinct()


def concurrency(df: DataFrame, keys: Sequence[str], bucket: str, resource: str,
                prefix: str = "") -> DataFrame:
    """Peak and mean number of distinct resources per time bucket, per entity."""
    seen = df.filter(F.col(resource).isNotNull()).select(*keys, bucket, resource).distinct()
    return (seen.groupBy(*keys, bucket).agg(F.count("*").alias("_n"))
            .groupBy(*keys).agg(F.max("_n").alias(f"{prefix}max_resources"),
                                F.avg("_n").alias(f"{prefix}avg_resources")))


def distinct_count(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Distinct known values per entity, collapsed before they are counted."""
    return (df.filter(F.col(value).isNotNull()).select(*keys, value).distinct()
            .groupBy(*keys).agg(F.count("*").alias(out)))


def distinct_resources(df: DataFrame, keys: Sequence[str], resource: str,
                       bucket: str | None = None, prefix: str = "") -> DataFrame:
    """Distinct resources per entity, and with ``bucket`` its distinct active buckets.

    A row without a resource does not count as one, but its bucket was active.
    """
    known = distinct_count(df, keys, resource, f"{prefix}distinct_resources")
    if bucket is None:
        return known
    active = (df.select(*keys, bucket).distinct()
              .groupBy(*keys).agg(F.count("*").alias(f"{prefix}active_buckets")))
    return active.join(known, list(keys), "left")


def resource_use(df: DataFrame, keys: Sequence[str], bucket: str, resource: str,
                 prefix: str = "") -> DataFrame:
    """``concurrency`` and ``distinct_resources`` together, from one collapse.

    Both branches start from the same distinct rows, whose shuffle Spark reuses.
    """
    seen = df.select(*keys, bucket, resource).distinct()
    per_bucket = seen.groupBy(*keys, bucket).agg(F.count(resource).alias("_n"))
    used = F.when(F.col("_n") > 0, F.col("_n"))
    busy = per_bucket.groupBy(*keys).agg(
        F.max(used).alias(f"{prefix}max_resources"), F.avg(used).alias(f"{prefix}avg_resources"),
        F.count("*").alias(f"{prefix}active_buckets"))
    known = (seen.groupBy(*keys, resource).agg(F.count("*").alias("_n"))
             .groupBy(*keys).agg(F.count(resource).alias("_r"))
             .select(*keys, F.when(F.col("_r") > 0, F.col("_r"))
                     .alias(f"{prefix}distinct_resources")))
    return busy.join(known, list(keys), "left")
