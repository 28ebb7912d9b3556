"""Structured Streaming: file and message sources, running aggregates, sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opspark.sources.text import json_table


def stream_source(spark: SparkSession, path: str, schema: T.StructType | str,
                  files_per_batch: int | None = None) -> DataFrame:
    """A folder (or a file pattern) as an unbounded table with a declared schema."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def kafka_source(spark: SparkSession, servers: str, topic: str,
                 starting: str = "earliest") -> DataFrame:
    """A topic replayed from ``starting``; needs the Kafka package on the classpath.

    Each query keeps its own offsets in its own checkpoint, so consumers are independent.
    """
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", starting).load())


def stream_json(stream: DataFrame, col: str, schema: T.StructType | str,
                keep: Sequence[str] = ()) -> DataFrame:
    """JSON messages of a stream, parsed and flattened."""
    return json_table(stream, col, schema, keep)


def running_agg(stream: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Totals per key that go on growing; Spark combines each batch before the state."""
    return stream.groupBy(*keys).agg(*aggs)


def windowed_agg(stream: DataFrame, time: str, size: str, late: str, keys: Sequence[str],
                 aggs: Sequence[Column]) -> DataFrame:
    """Totals per event-time window; windows older than ``late`` are closed."""
    return (stream.withWatermark(time, late)
            .groupBy(F.window(time, size).alias("window"), *keys).agg(*aggs))


def run_available(df: DataFrame, path: str, checkpoint: str,
                  timeout: int | None = None) -> DataFrame:
    """Process what is there, stop, and return all totals.

    Each batch's totals replace the Parquet table at ``path``, written by the
    executors; a batch that is done again after a failure replaces them alike.
    """
    def put(totals: DataFrame, batch: int) -> None:
        totals.write.mode("overwrite").parquet(path)

    query = (df.writeStream.outputMode("complete").foreachBatch(put)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    _finish(query, timeout)
    if query.lastProgress is None:  # nothing was there
        df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_files(df: DataFrame, path: str, files: int) -> str:
    """Write ``df`` as about so many files, a backlog that a stream takes batch by batch."""
    df.repartition(files).write.parquet(path)
    return path


class Enough(Exception):
    """Ends a stream after the batches it was asked for."""


def run_batches(df: DataFrame, path: str, checkpoint: str, batches: int,
                timeout: int | None = None) -> int:
    """Process so many batches and stop, as a consumer that goes away would.

    The batch after them fails before it writes anything, so its files are not counted;
    what is done is in the checkpoint, and ``run_available`` on it goes on from there.
    Returns the batches done (fewer where there is no more data).
    """
    done: list[int] = []

    def put(totals: DataFrame, batch: int) -> None:
        if len(done) == batches:
            raise Enough
        totals.write.mode("overwrite").parquet(path)
        done.append(batch)

    query = (df.writeStream.outputMode("complete").foreachBatch(put)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    try:
        _finish(query, timeout)
    except StreamingQueryException:
        if len(done) < batches:
            raise
    return len(done)


def run_to_files(df: DataFrame, path: str, checkpoint: str,
                 timeout: int | None = None) -> DataFrame:
    """Process what is there into a Parquet table, each closed row exactly once."""
    query = (df.writeStream.outputMode("append").format("parquet").option("path", path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    _finish(query, timeout)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _finish(query, timeout: int | None) -> None:
    """Wait for the end; a limit is the caller's choice, as a backlog has no natural one."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} still running after {timeout} s")
