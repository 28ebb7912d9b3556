"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opspark.session import scratch_path

MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``stored``, and the path, for tables that are removed again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def text_of(value: str | None) -> str:
    return value or ""


def split_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8: bytes.split() cuts at exactly those characters."""
    return text.encode("utf-8", "replace").split() if text else []


def worker_cache(name: str, make, key=None):
    """A value kept by a Python worker across tasks. It holds one: a worker that goes on with
    another operator, or the same with another ``key``, lets the old value go first, and its
    memory with it."""
    kept = vars(sys).setdefault("_opspark_worker_cache", {})
    if kept.get("of") != (name, key):
        kept.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        kept["value"] = make()
        kept["of"] = name, key
    return kept["value"]


ARROW_ROWS, ARROW_BYTES, READ_ROWS = 1000, 1_000_000, 512


def small_batches(spark: SparkSession) -> None:
    """Hold the session's batches to few rows and about ``ARROW_BYTES``, as whole texts are long:
    an Arrow batch is held by the executor and by its Python worker at once, on the way in and
    on the way out, and the Parquet reader has a batch's texts in one array."""
    arrow = "spark.sql.execution.arrow.max{}PerBatch"
    for setting, most in ((arrow.format("Records"), ARROW_ROWS), (arrow.format("Bytes"), ARROW_BYTES),
                          ("spark.sql.parquet.columnarReaderBatchSize", READ_ROWS)):
        if not 0 < int(spark.conf.get(setting).rstrip("bB")) <= most:
            spark.conf.set(setting, str(most))


ROW = "_row"


def carried(docs: DataFrame, **columns: Column) -> DataFrame:
    """Each row of ``docs`` as a struct ``_row``, beside ``columns``: no names can clash."""
    return docs.select(F.struct("*").alias(ROW), *[c.alias(n) for n, c in columns.items()])


def named(name: str) -> Column:
    """The column of just this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def uncarried(rows: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of ``carried`` rows again; ``changed`` columns take new values."""
    kept = {c: F.col(f"{ROW}.`" + c.replace("`", "``") + "`") for c in columns}
    return rows.select(*[(kept | changed)[c].alias(c) for c in columns])


class WordHash(dict):
    """64-bit hashes of words. A bounded memo: when full it starts afresh."""

    def __init__(self, limit: int = 250_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def word_hash() -> WordHash:
    return worker_cache("word_hash", WordHash)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in parts of a few rows, so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of equal ``key`` from batches sorted by it, across batch borders."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(edges, edges[1:]):
            if held and keys[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = keys[a]
    if held:
        yield pa.Table.from_batches(held)


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) for f in schema], schema=schema)
