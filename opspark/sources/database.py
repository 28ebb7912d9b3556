"""Relational databases: range-split reads and bulk export.

Where a JDBC driver is on the classpath, use ``jdbc_read`` and ``jdbc_write``.
``SplitSource`` does the same split for any Python DB-API driver.
"""

from __future__ import annotations

import importlib
import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from opspark.functions.columns import as_col
from opspark.session import ship

ship(sys.modules[__name__])


def split_ranges(low: int, high: int, n: int) -> list[tuple[int, int]]:
    """n inclusive key ranges of one stride; the last takes the remainder."""
    n = max(1, min(n, high - low + 1))
    stride = (high - low + 1) // n
    return [(low + i * stride, high if i == n - 1 else low + (i + 1) * stride - 1)
            for i in range(n)]


def split_index(key: Column | str, low: Column, high: Column, n: int) -> Column:
    """Which of the ranges of ``split_ranges`` a key falls in, 0-based."""
    n_used = F.greatest(F.lit(1), F.least(F.lit(n), high - low + 1))
    stride = F.floor((high - low + 1) / n_used)
    return F.least(F.floor((as_col(key) - low) / stride), n_used - 1).cast("int")


class _Range(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class _SplitReader(DataSourceReader):
    def __init__(self, schema, options):
        self.columns = [f.name for f in schema.fields]
        self.options = options

    def _connect(self):
        return importlib.import_module(self.options["driver"]).connect(self.options["database"])

    def partitions(self):
        key, table = self.options["key"], self.options["dbtable"]
        con = self._connect()
        try:
            cursor = con.cursor()
            cursor.execute(f"SELECT min({key}), max({key}) FROM {table}")
            low, high = cursor.fetchone()
        finally:
            con.close()
        if low is None:
            return []
        return [_Range(a, b) for a, b in
                split_ranges(low, high, int(self.options.get("numPartitions", "4")))]

    def read(self, partition):
        key, table = self.options["key"], self.options["dbtable"]
        con = self._connect()
        try:
            cursor = con.cursor()
            cursor.execute(f"SELECT {', '.join(self.columns)} FROM {table} "
                           f"WHERE {key} BETWEEN ? AND ?", (partition.low, partition.high))
            while rows := cursor.fetchmany(10_000):
                yield from (tuple(r) for r in rows)
        finally:
            con.close()


class SplitSource(DataSource):
    """``spark.read.format("split_db")``: one query per key range, run in parallel.

    Options: driver (a DB-API module), database, dbtable, key, numPartitions.
    The schema has to be given.
    """

    @classmethod
    def name(cls):
        return "split_db"

    def schema(self):
        raise ValueError("split_db needs an explicit schema")

    def reader(self, schema):
        return _SplitReader(schema, self.options)


def split_read(spark: SparkSession, driver: str, database: str, table: str, key: str,
               schema: str, n: int = 4) -> DataFrame:
    spark.dataSource.register(SplitSource)
    return (spark.read.format("split_db").schema(schema).option("driver", driver)
            .option("database", database).option("dbtable", table).option("key", key)
            .option("numPartitions", n).load())


def jdbc_read(spark: SparkSession, url: str, table: str, key: str, low: int, high: int,
              n: int, **options) -> DataFrame:
    return (spark.read.format("jdbc").options(**options).option("url", url)
            .option("dbtable", table).option("partitionColumn", key)
            .option("lowerBound", low).option("upperBound", high)
            .option("numPartitions", n).load())


def jdbc_write(df: DataFrame, url: str, table: str, mode: str = "append", **options) -> None:
    df.write.format("jdbc").options(**options).option("url", url).option(
        "dbtable", table).mode(mode).save()


def export(df: DataFrame, driver: str, database: str, table: str, key: Sequence[str],
           batch: int = 5_000) -> None:
    """Write each partition through a DB-API driver, replacing rows by key.

    Replacing makes a retried task harmless: it writes the same rows again. The
    target needs a unique constraint on the key.
    """
    cols = df.columns
    if missing := set(key) - set(cols):
        raise ValueError(f"key columns not in the data: {sorted(missing)}")
    marks = ", ".join("?" for _ in cols)
    update = ", ".join(f"{c} = excluded.{c}" for c in cols if c not in key)
    action = f"DO UPDATE SET {update}" if update else "DO NOTHING"
    sql = (f"INSERT INTO {table} ({', '.join(cols)}) VALUES ({marks}) "
           f"ON CONFLICT ({', '.join(key)}) {action}")

    def write(rows):
        con = importlib.import_module(driver).connect(database)
        try:
            block = []
            for row in rows:
                block.append(tuple(row))
                if len(block) == batch:
                    con.executemany(sql, block)
                    con.commit()
                    block = []
            if block:
                con.executemany(sql, block)
            con.commit()
        finally:
            con.close()

    df.foreachPartition(write)
