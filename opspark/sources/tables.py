"""Catalog tables: managed, partitioned and bucketed, external."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opspark.functions.columns import as_col
from opspark.functions.keys import row_key


def register_table(df: DataFrame, db: str, name: str, location: str | None = None) -> DataFrame:
    """A managed table in its own database; running it again replaces it."""
    spark = df.sparkSession
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`{place}")
    df.write.mode("overwrite").format("parquet").saveAsTable(f"{db}.{name}")
    return spark.table(f"{db}.{name}")


def write_layout(df: DataFrame, table: str, by: str, bucket: str, buckets: int, sort: str,
                 path: str | None = None) -> DataFrame:
    """A table partitioned by one column, bucketed and sorted by another.

    The rebalance hint sends a partition's rows together, so there are few files
    per partition, and lets adaptive execution split a partition that holds a
    large part of the rows.
    """
    writer = (df.hint("rebalance", F.col(by), F.col(bucket)).write.mode("overwrite")
              .format("parquet").partitionBy(by).bucketBy(buckets, bucket).sortBy(sort))
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str) -> DataFrame:
    """A table in so many buckets of ``key``, sorted by it, one file per bucket.

    Tables bucketed alike are joined and grouped by the key bucket by bucket: the rows of
    a key are in one bucket of each, so nothing is shuffled again.
    """
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))
    return df.sparkSession.table(table)


def join_buckets(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """The join of two tables bucketed alike: sorted buckets are merged where they are."""
    return left.hint("merge").join(right, key, how)


def partitions(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {table}")


def attach_table(spark: SparkSession, table: str, path: str, columns: str,
                 by: Sequence[str]) -> DataFrame:
    """An external table over partition folders already on disk.

    ``columns`` is the DDL column list, partition columns included.
    """
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet "
              f"PARTITIONED BY ({', '.join(by)}) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {table}")
    return spark.table(table)


def row_key_view(df: DataFrame, prefix: str, ident: str,
                 families: dict[str, Sequence[str]], width: int = 6,
                 ordered: bool = True) -> DataFrame:
    """A sortable row key and one struct per column family."""
    view = df.select(row_key(prefix, ident, width).alias("row_key"),
                     *[F.struct(*cols).alias(name) for name, cols in families.items()])
    return view.orderBy("row_key") if ordered else view


def prefix_scan(df: DataFrame, prefix: str, col: str = "row_key") -> DataFrame:
    """Rows whose key starts with the prefix; the filter reaches the scan."""
    return df.filter(as_col(col).startswith(prefix))


def key_layout(df: DataFrame, key: Sequence[str], clustering: Sequence) -> DataFrame:
    """Rows of a key side by side and in clustering order, ready to be written.

    Ranges over key and clustering together: a very large key spans several files
    in a row instead of filling one task.
    """
    order = [*[F.col(k) for k in key], *clustering]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)
