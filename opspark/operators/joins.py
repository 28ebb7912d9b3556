"""Join operators: key hygiene, lookups, nested fallback, checked joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opspark.operators.scan import HOT_ROWS, hot_keys, split_hot
from opspark.session import measured

MIN_SITE_COVERAGE = 0.01


def skew_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
              hot: DataFrame | None = None) -> DataFrame:
    """A join in which one key may own a large part of the left rows.

    ``hot`` holds those keys (there are few: each has more than a fixed number of
    rows). Their rows meet the few right rows they need without a shuffle, so
    they stay spread as they were; all other rows take the ordinary join. The
    right side has to be one row per key, or a few.
    """
    if hot is None:
        return left.join(right, list(keys), how)
    cold_rows, hot_part = split_hot(left, keys, hot)
    _, needed = split_hot(right, keys, hot)
    return cold_rows.join(right, list(keys), how).unionByName(
        hot_part.join(measured(needed), list(keys), how))


def lookup_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left",
                hot_rows: int | None = None) -> DataFrame:
    """Join an already measured lookup: broadcast by its size, else shuffled, where
    adaptive execution splits a hot key. With ``hot_rows`` hot keys are looked for
    beforehand and stay spread in either case."""
    return skew_join(left, right, keys, how, hot_keys(left, keys, hot_rows) if hot_rows else None)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys owning more than one row, with the row count ``n``."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def drop_colliding(df: DataFrame, keys: Sequence[str], *others: DataFrame,
                   hot_rows: int = HOT_ROWS) -> tuple[list[DataFrame], DataFrame]:
    """Drop every row of a key that repeats in ``df``, from ``df`` and ``others``.

    Returns the cleaned tables and a one-row report (colliding_keys, dropped_rows).
    The row count comes from the key counts, so no join is needed for it. Keys
    with very many rows are dropped first, against a list too short to shuffle
    for, so those rows are never brought together.
    """
    dup = measured(duplicate_keys(df, keys))
    report = dup.agg(F.count("*").alias("colliding_keys"),
                     F.coalesce(F.sum("n"), F.lit(0)).alias("dropped_rows"))
    bare = dup.select(*keys)
    hot = measured(dup.filter(F.col("n") > hot_rows).select(*keys))
    tables = [df, *others]
    if not hot.isEmpty():
        tables = [t.join(hot, list(keys), "left_anti") for t in tables]
    return [t.join(bare, list(keys), "left_anti") for t in tables], report


def attach_rollup(parent: DataFrame, rollup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Parent rows kept whole; rows without children get nulls."""
    return parent.join(rollup, list(keys), "left")


def seat_join(parts: DataFrame, txns: DataFrame, key: str, part_cols: Sequence[str],
              txn_cols: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """Participant rows with their transaction's attributes.

    Both sides are cut to the named columns first, so only those are shuffled. The
    key is nearly unique, so rows are not counted beforehand: adaptive execution
    splits a transaction that turns out large. With ``hot_rows`` such transactions
    are looked for and kept spread from the start.
    """
    return skew_join(parts.select(key, *part_cols), txns.select(key, *txn_cols), [key],
                     hot=hot_keys(parts, [key], hot_rows) if hot_rows else None)


def with_lookup(df: DataFrame, small: DataFrame, keys: Sequence[str] | str,
                how: str = "inner") -> DataFrame:
    """Attach a lookup; it is broadcast only if its measured size allows."""
    return df.join(measured(small), keys if isinstance(keys, str) else list(keys), how)


def assemble(base: DataFrame, aggs: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Left joins of several per-entity tables; one partitioning serves them all."""
    return reduce(lambda left, right: left.join(right, list(keys), "left"), aggs, base)


def keep_sites(df: DataFrame, coverage: DataFrame, site: str = "site",
               share: str = "coverage", minimum: float = MIN_SITE_COVERAGE) -> DataFrame:
    """Rows of sites whose coverage reaches the minimum."""
    kept = measured(coverage.filter(F.col(share) >= minimum).select(site))
    return df.join(kept, site, "left_semi")


def value_table(features: DataFrame, scores: DataFrame, fees: DataFrame,
                segments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Features, scores and fees of the entities that have all three; segment if any."""
    keys = list(keys)
    return features.join(scores, keys).join(fees, keys).join(segments, keys, "left")


def checked_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                 not_null: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """A left join that has to stay one-to-one, and the checks that say whether it did.

    The checks table has the columns check, got, want, ok.
    """
    joined = left.join(right, list(keys), "left")
    got = joined.agg(
        F.count("*").alias("rows"),
        *[F.coalesce(F.sum(F.col(c).isNull().cast("bigint")), F.lit(0)).alias(f"null {c}")
          for c in not_null])
    want = left.agg(F.count("*").alias("want")).scalar()
    checks = (got.unpivot([], got.columns, "check", "got")
              .withColumn("want", F.when(F.col("check") == "rows", want)
                          .otherwise(F.lit(0).cast("bigint")))
              .withColumn("ok", F.col("got") == F.col("want")))
    return joined, checks


def label_pairs(a: DataFrame, b: DataFrame, keys: Sequence[str], label_a: str,
                label_b: str) -> DataFrame:
    """Two labelings of the same entities side by side, as columns a and b."""
    return a.select(*keys, F.col(label_a).alias("a")).join(
        b.select(*keys, F.col(label_b).alias("b")), list(keys))


def group_mean_baseline(train: DataFrame, test: DataFrame, group: Sequence[str],
                        target: str, out: str = "baseline") -> DataFrame:
    """The training mean of each row's group; the grand mean for unseen groups."""
    group = list(group)
    means = measured(train.groupBy(*group).agg(F.avg(target).alias(out)))
    grand = train.agg(F.avg(target).alias("grand")).scalar()
    return test.join(means, group, "left").withColumn(out, F.coalesce(F.col(out), grand))
