"""Isotonic regression whose points are never on one machine.

The least-squares rising fit is found by pooling adjacent violators. Pooling may be done
in any order, so each range block of the points is pooled on its own, by a stack of
(sum, weight) pairs. What remains wrong are pools at the blocks' borders: the pools are
dealt again, into fewer blocks or blocks with other borders, until no pool has a lower
mean than the one before it. Only counts and one row per block are looked at in between.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opspark.functions.columns import as_col
from opspark.operators.scan import Measure, running
from opspark.session import cut, ship

ship(sys.modules[__name__])

BLOCK_POINTS = 1_000_000  # points or pools of a block
POOL = "lo double, hi double, total double, weight double"


def pool_block(lo, hi, total, weight) -> list[tuple[float, float, float, float]]:
    """The pools of points in ascending order; their means rise strictly."""
    stack: list[tuple[float, float, float, float]] = []
    for top in zip(lo, hi, total, weight):
        while stack and stack[-1][2] * top[3] >= top[2] * stack[-1][3]:
            low = stack.pop()
            top = low[0], top[1], low[2] + top[2], low[3] + top[3]
        stack.append(top)
    return stack


def _pooled(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: list[tuple[float, float, float, float]] = []
    for part in parts:  # a block may come in several batches: its stack goes on
        both = [*held, *part[["lo", "hi", "total", "weight"]].itertuples(index=False, name=None)]
        held = pool_block(*zip(*both)) if both else []
    yield pd.DataFrame(held, columns=["lo", "hi", "total", "weight"])


def isotonic_pools(rows: DataFrame, x: Column | str, label: Column | str,
                   block: int = BLOCK_POINTS) -> DataFrame:
    """The pools of the rising fit of ``label`` on ``x``: lo, hi, total, weight, value.

    A pool is a range of x with one fitted value, total / weight; values rise strictly.
    Equal x are one weighted point. Rows with a null x or label take no part; without
    rows there are no pools.
    """
    points = rows.select(as_col(x).cast("double").alias("lo"), as_col(label).cast("double").alias("y"))
    pools = cut(points.dropna().groupBy("lo").agg(
        F.sum("y").alias("total"), F.count("*").cast("double").alias("weight"))
        .select("lo", F.col("lo").alias("hi"), "total", "weight"))
    blocks = max(1, -(-pools.count() // block))
    mean = F.col("total") / F.col("weight")
    while True:
        pools = cut(pools.drop("block").repartitionByRange(blocks, "lo").sortWithinPartitions("lo")
                    .mapInPandas(_pooled, POOL).withColumn("block", F.spark_partition_id()))
        if blocks == 1:
            break
        # One row per block: a small window.
        ends = pools.groupBy("block").agg(F.min_by(mean, "lo").alias("first"),
                                          F.max_by(mean, "lo").alias("last"))
        before = F.lag("last").over(W.orderBy("block"))
        if ends.withColumn("before", before).filter("before >= first").isEmpty():
            break
        fewer = max(1, -(-pools.count() // block))
        blocks = fewer if fewer < blocks else blocks + 1  # other borders in any case
    return pools.select("lo", "hi", "total", "weight", mean.alias("value"))


def apply_pools(df: DataFrame, pools: DataFrame, x: str, out: str) -> DataFrame:
    """``df`` with the fit at ``x`` as ``out``.

    Inside a pool that is its value, between two the straight line from the end of one to
    the start of the next, beyond them the nearest pool's value; null for a null x, and
    where there are no pools. Distinct values of x meet the pools in two ordered scans, so
    neither side has to fit anywhere.
    """
    ends = pools.select(F.explode(F.array_distinct(F.array("lo", "hi"))).alias("x"), "value")
    events = ends.select("x", F.lit(0).alias("kind"), F.struct("x", "value").alias("end")).unionByName(
        df.select(F.col(x).cast("double").alias("x")).distinct().dropna().select(
            "x", F.lit(1).alias("kind"), F.lit(None).cast("struct<x: double, value: double>").alias("end")))
    below = running(events, ["x", "kind"], [Measure("below", "last", "end")]).filter("kind = 1")
    above = (running(events.withColumn("y", -F.col("x")), ["y", "kind"], [Measure("above", "last", "end")])
             .filter("kind = 1").select("x", "above"))
    step = (F.col("x") - F.col("below.x")) / (F.col("above.x") - F.col("below.x"))
    value = F.when(F.col("below").isNull(), F.col("above.value")).when(
        F.col("above").isNull() | (F.col("above.x") == F.col("below.x")), F.col("below.value")).otherwise(
        F.col("below.value") + step * (F.col("above.value") - F.col("below.value")))
    fitted = below.join(above, "x").select(F.col("x").alias("_x"), value.alias(out))
    return df.join(fitted, F.col(x).cast("double") == F.col("_x"), "left").drop("_x")
