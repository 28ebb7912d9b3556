"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from math import ceil
from types import ModuleType

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession


# Rows of a task of a fit: below the least its start takes longer than its work; the most bound its memory.
LEAST_ROWS, MOST_ROWS = 4_000, 250_000


def ship(module: ModuleType) -> None:
    """Send a module's functions to the executors with the task, not by import.

    The few functions that run in Python workers then need nothing installed there.
    """
    cloudpickle.register_pickle_by_value(module)


def build_session(app: str = "opspark", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are tuned for.

    Adaptive execution does the runtime work: it coalesces small shuffle
    partitions, splits skewed join partitions, and turns a sort-merge join into
    a broadcast one when the measured side is small.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only where the session names none and runs on this machine alone (a local test
    run) is one made here; it is removed when Python ends. On a cluster a missing
    setting is an error: a machine's own folder is not seen by the others.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="opspark-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return os.path.join(shared_folder(spark), "opspark", f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, column by column."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and return the stored copy.

    The copy is read from reliable storage, so a lost executor never causes the
    lineage above it (or a partition number in it) to be computed again.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def packed(df: DataFrame) -> DataFrame:
    """A stored table in few partitions, for fits: they pass over it hundreds of times in short
    stages, so what a stage costs should follow the rows and not the shuffle that made the table.

    One partition a core, fewer if rows are few, more if they are many; nothing is shuffled.
    """
    rows, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(1, min(cores, rows // LEAST_ROWS), ceil(rows / MOST_ROWS)))


def measured(df: DataFrame) -> DataFrame:
    """Materialise a side of a join so that its real size is known.

    Once cached and counted, the size Catalyst sees is the stored size, not an
    estimate: under the session's broadcast threshold the side is broadcast, and
    above it the join shuffles. No hint is needed, so no side is ever broadcast
    unchecked. Meant for aggregates, which are much smaller than their input.
    """
    df = df.persist()
    df.count()
    return df
