"""Exact order statistics of many columns without a sort.

The value at a rank is closed in from both sides. A pass over the columns sketches what
is inside the present bracket (Spark's quantile summary, merged map-side) and proposes a
much narrower one; a second pass counts exactly what lies below and up to its ends, so
the bracket is always right, whatever the sketch's error. When few values are left they
are counted one by one. All ranks of all columns share the passes, no row is shuffled
before the last step, and the driver sees a few numbers per rank.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ROOM = 200_000  # values of a bracket that are counted one by one
ACCURACY = 10_000  # of the sketch: its rank error is a share 1 / ACCURACY


@dataclass
class Target:
    """A rank (from 1) of a column, and the bracket [low, high] that holds its value."""

    col: str
    rank: int
    low: object
    high: object
    below: int  # values under low
    inside: int

    @property
    def found(self) -> bool:
        return self.low == self.high

    def within(self) -> Column:
        return F.col(self.col).between(F.lit(self.low), F.lit(self.high))


def _whole_rank(p: float, n: int) -> int:
    """ceil(p * n), at least 1, in whole numbers."""
    return max(1, math.ceil(Fraction(p).limit_denominator(10**6) * n))


def _narrowed(df: DataFrame, targets: list[Target], accuracy: int) -> None:
    """Narrow the brackets by one sketch and one exact count."""
    sketches = []
    for i, t in enumerate(targets):
        share, slack = (t.rank - t.below - 0.5) / t.inside, 2 / accuracy
        ends = [max(0.0, share - slack), min(1.0, share + slack)]
        sketches.append(F.percentile_approx(F.when(t.within(), F.col(t.col)), ends, accuracy)
                        .alias(f"s{i}"))
    ends = df.agg(*sketches).first()
    counts = []
    for i, t in enumerate(targets):
        for k, end in enumerate(ends[i]):
            value = F.col(t.col)
            counts += [F.count(F.when(value < F.lit(end), 1)).alias(f"u{i}{k}"),
                       F.count(F.when(value <= F.lit(end), 1)).alias(f"v{i}{k}")]
    row = df.agg(*counts).first()
    for i, t in enumerate(targets):
        upto = t.below + t.inside
        for k, end in enumerate(ends[i]):
            under, through = row[f"u{i}{k}"], row[f"v{i}{k}"]
            if under >= t.rank:  # the value is under this end
                t.high, upto = min(t.high, end), min(upto, through)
            elif through >= t.rank:  # it is this end
                t.low = t.high = end
                t.below, upto = under, through
            else:
                t.low, t.below = max(t.low, end), max(t.below, under)
        t.inside = upto - t.below


def order_statistics(df: DataFrame, ranks: Mapping[str, Sequence[int]], room: int = ROOM,
                     accuracy: int = ACCURACY) -> dict[tuple[str, int], object]:
    """The value at each rank (from 1, ascending, nulls left out) of each numeric column.

    Ranks beyond a column's values are left out of the result.
    """
    cols = [c for c in ranks if ranks[c]]
    if not cols:
        return {}
    first = df.agg(*[f(c).alias(f"{f.__name__}{i}") for i, c in enumerate(cols)
                     for f in (F.count, F.min, F.max)]).first()
    targets = [Target(c, r, first[f"min{i}"], first[f"max{i}"], 0, first[f"count{i}"])
               for i, c in enumerate(cols) for r in dict.fromkeys(ranks[c])
               if 1 <= r <= first[f"count{i}"]]
    for t in targets:
        if t.rank in (1, t.inside):
            t.low = t.high = t.low if t.rank == 1 else t.high
    while True:
        wide = [t for t in targets if not t.found and t.inside > room]
        before = [(t.low, t.high) for t in wide]
        if wide:
            _narrowed(df, wide, accuracy)
        if before == [(t.low, t.high) for t in wide]:  # none is wide, or no end moves
            break
    left = [t for t in targets if not t.found]
    if left:
        held = F.array_compact(F.array(*[
            F.when(t.within(), F.struct(F.lit(i).alias("i"), F.col(t.col).cast("double").alias("x")))
            for i, t in enumerate(left)]))
        counts = df.select(F.explode(held).alias("h")).groupBy("h.i", "h.x").agg(
            F.count("*").alias("n"))
        # A bracket holds few values: a small window for each.
        upto = F.sum("n").over(W.partitionBy("i").orderBy("x"))
        rank = F.element_at(F.array(*[F.lit(t.rank - t.below) for t in left]), F.col("i") + 1)
        got = (counts.withColumn("upto", upto).filter(F.col("upto") >= rank).groupBy("i")
               .agg(F.min("x").alias("x")).collect())
        for r in got:
            left[r.i].low = left[r.i].high = r.x
    return {(t.col, t.rank): t.low for t in targets}


def column_percentiles(df: DataFrame, cols: Sequence[str], points: Mapping[str, float],
                       room: int = ROOM) -> DataFrame:
    """Discrete percentiles (the least value covering a share p of the rows), a row per column.

    Values are doubles; a column without any value has no row.
    """
    df = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    sizes = df.agg(*[F.count(f"c{i}") for i in range(len(cols))]).first()
    want = {f"c{i}": [_whole_rank(p, n) for p in points.values()] for i, n in enumerate(sizes) if n}
    found = order_statistics(df, want, room)
    rows = [(cols[int(c[1:])], *[float(found[c, r]) for r in ranks]) for c, ranks in want.items()]
    return df.sparkSession.createDataFrame(
        rows, "`column` string, " + ", ".join(f"`{n}` double" for n in points))
