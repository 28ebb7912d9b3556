"""Reading clusters: agreement, nearest prototype, names by rule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opspark.session import measured


def agreement(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Purity of labeling b against a: rows sharing the commonest a inside each b."""
    counts = pairs.groupBy(b, a).agg(F.count("*").alias("_n"))
    per = counts.groupBy(b).agg(F.max("_n").alias("_top"), F.sum("_n").alias("_all"))
    return per.agg(F.sum("_top").alias("agreeing"), F.sum("_all").alias("n"),
                   F.count("*").alias("labels_b")).withColumn(
        "agreement", F.when(F.col("n") > 0, F.col("agreeing") / F.col("n")))


def nearest_prototype(clusters: DataFrame, cluster: str, axes: Sequence[str],
                      prototypes: Mapping[str, Sequence[float]],
                      scales: Sequence[float] | None = None) -> DataFrame:
    """The closest named prototype of each cluster; the first one wins a tie.

    The prototypes are a short fixed list, so each is a column expression and
    no pairing of tables is needed. ``scales`` divides an axis to damp it.
    """
    scales = scales or [1.0] * len(axes)

    def distance(point):
        parts = [((F.col(a) - F.lit(float(v))) / F.lit(float(s))) for a, v, s
                 in zip(axes, point, scales)]
        total = F.lit(0.0)
        for part in parts:
            total = total + part * part
        return total

    options = F.array(*[F.struct(distance(p).alias("d"), F.lit(i).alias("i"),
                                 F.lit(name).alias("name"))
                        for i, (name, p) in enumerate(prototypes.items())])
    best = clusters.withColumn("_best", F.array_min(options))
    return best.select(cluster, F.col("_best.name").alias("nearest"),
                       F.sqrt("_best.d").alias("distance"))


def name_by_rules(profile: DataFrame, cluster: str, rules: Sequence[tuple[str, str]],
                  rest: str) -> DataFrame:
    """Name clusters by what they measure: the top of each rule's column, in turn.

    A cluster taken by an earlier rule is out of the later ones; the remainder
    gets ``rest``. The profile has one row per cluster.
    """
    named = measured(profile).withColumn("name", F.lit(None).cast("string"))
    for name, col in rules:
        free = F.col("name").isNull()
        pick = named.agg(F.max_by(F.when(free, F.col(cluster)), F.when(
            free, F.struct(col, (-F.col(cluster)).alias("low")))).alias("pick")).scalar()
        named = named.withColumn("name", F.when(
            F.col("name").isNull() & (F.col(cluster) == pick), name).otherwise(F.col("name")))
    return named.withColumn("name", F.coalesce("name", F.lit(rest)))
