"""Files: projected scans, re-runnable sinks, materialised steps, increments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan(spark: SparkSession, path: str, cols: Sequence[str] | None = None,
         parts: int | None = None, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table, or its first ``parts`` files by name for a trial run.

    Tables written part for part from the same input give matching subsets.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    if parts is not None:
        files = sorted(df.inputFiles())[:parts]
        df = reader.option("basePath", path).parquet(*files)
    return df.select(*cols) if cols else df


def write_parquet(df: DataFrame, path: str, by: Sequence[str] = (),
                  max_records: int | None = None) -> DataFrame:
    """Replace a Parquet table as a whole (no part of an earlier run stays) and read it back."""
    writer = df.write.mode("overwrite")
    if by:
        writer = writer.partitionBy(*by)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def materialise(df: DataFrame, path: str, rebuild: bool = False) -> DataFrame:
    """A costly step, computed once: reused if the table is there, unless ``rebuild``."""
    if not rebuild:
        try:
            return df.sparkSession.read.parquet(path)
        except AnalysisException:
            pass
    return write_parquet(df, path)


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """CSV with a header. ``single`` is for reports: one task writes one file."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def incremental(df: DataFrame, key: str, last_value) -> DataFrame:
    """Only the rows above the high-water mark; all of them if there is none yet."""
    if last_value is None:
        return df
    mark = last_value if isinstance(last_value, Column) else F.lit(last_value)
    return df.filter(F.col(key) > mark)


def append_increment(df: DataFrame, key: str, path: str):
    """Append the rows above the target's own mark; returns the new mark.

    The mark is read from the target, so a run that is repeated appends nothing twice.
    """
    spark = df.sparkSession
    try:
        last = spark.read.parquet(path).agg(F.max(key)).first()[0]
    except AnalysisException:
        last = None
    incremental(df, key, last).write.mode("append").parquet(path)
    return spark.read.parquet(path).agg(F.max(key)).first()[0]


def part_manifest(df: DataFrame, key: str, parts: int) -> DataFrame:
    """(part, lo): ranges of ``key`` with about equal numbers of rows, for several tables.

    Part p holds the keys from its ``lo`` up to the next one's; the first begins at null,
    so that it takes smaller keys too. Few rows by construction: ``parts`` at most.
    """
    cuts = [i / parts for i in range(1, parts)]
    if not cuts:
        return df.sparkSession.createDataFrame([(0, None)], f"part int, lo {df.schema[key].dataType.simpleString()}")
    found = df.agg(F.percentile_approx(key, cuts).alias("cuts"))
    ends = found.select(F.explode(F.array_sort(F.array_distinct(F.concat(
        F.array(F.lit(None).cast(df.schema[key].dataType)), "cuts")))).alias("lo"))
    bounds = [r.lo for r in ends.collect()]
    bounds = [None, *sorted(b for b in bounds if b is not None)]
    return df.sparkSession.createDataFrame(
        list(enumerate(bounds)), f"part int, lo {df.schema[key].dataType.simpleString()}")


def write_parts(df: DataFrame, key: str, manifest: DataFrame, path: str) -> None:
    """Write a table in the parts of a manifest, one folder each; null keys are in part 0."""
    part = F.lit(0)
    for r in manifest.filter("lo IS NOT NULL").orderBy("part").collect():
        part = F.when(F.col(key) >= F.lit(r.lo), r.part).otherwise(part)
    (df.withColumn("part", part).repartition("part").sortWithinPartitions("part").write
     .mode("overwrite").partitionBy("part").parquet(path))


def scan_parts(spark: SparkSession, path: str, schema: T.StructType, parts: int | None = None,
               cols: Sequence[str] | None = None) -> DataFrame:
    """The first ``parts`` parts of such a table (all without a number); others are not read.

    Tables written by one manifest give the same keys for the same number.
    """
    df = spark.read.schema(T.StructType([*schema, T.StructField("part", T.IntegerType())])).parquet(path)
    if parts is not None:
        df = df.filter(F.col("part") < parts)
    return df.select(*(cols or schema.names))
