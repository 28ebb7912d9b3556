"""Classification and regression metrics as one-pass aggregates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opspark.functions.columns import flag_sum

METRIC_SCHEMA = T.StructType([
    T.StructField("metric", T.StringType(), False),
    T.StructField("slice", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
])


def with_rates(df: DataFrame) -> DataFrame:
    """Rates from tp, fp, tn, fn; a rate without a denominator is 0."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))

    def rate(x, y):
        return F.when(y > 0, x / y).otherwise(0.0)

    return (df.withColumn("precision", rate(tp, tp + fp))
            .withColumn("recall", rate(tp, tp + fn))
            .withColumn("f1", F.when(
                F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall")
                / (F.col("precision") + F.col("recall"))).otherwise(0.0))
            .withColumn("accuracy", rate(tp + tn, tp + fp + tn + fn))
            .withColumn("specificity", rate(tn, tn + fp)))


def confusion(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts and rates in one aggregate."""
    y, p = F.col(label), F.col(pred)
    return with_rates(df.groupBy(*by).agg(
        flag_sum((y == 1) & (p == 1)).alias("tp"), flag_sum((y == 0) & (p == 1)).alias("fp"),
        flag_sum((y == 0) & (p == 0)).alias("tn"), flag_sum((y == 1) & (p == 0)).alias("fn")))


def skill(df: DataFrame, y: str, baseline: str, pred: str, by: Sequence[str] = (),
          min_n: int = 0) -> DataFrame:
    """1 - SSE(model)/SSE(baseline): what a model adds to a stated dumb rule."""
    def sq(c):
        return F.sum((F.col(y) - F.col(c)) * (F.col(y) - F.col(c)))

    def absolute(c):
        return F.avg(F.abs(F.col(y) - F.col(c)))

    s = df.groupBy(*by).agg(
        F.count("*").alias("n"), sq(pred).alias("_m"), sq(baseline).alias("_b"),
        absolute(pred).alias("mae"), absolute(baseline).alias("baseline_mae"))
    return (s.filter(F.col("n") >= min_n)
            .withColumn("skill", F.when(F.col("_b") > 0, 1 - F.col("_m") / F.col("_b")))
            .withColumn("rmse", F.sqrt(F.col("_m") / F.col("n")))
            .withColumn("baseline_rmse", F.sqrt(F.col("_b") / F.col("n"))).drop("_m", "_b"))


def threshold_sweep(df: DataFrame, n: str, value: str, thresholds: Sequence[int],
                    bound: float = 200.0) -> DataFrame:
    """For each minimum n: rows kept, their median, and the share of outliers.

    A row belongs to every threshold at or below its n, so it is repeated at
    most once per threshold and combined again map-side.
    """
    from opspark.operators.rollup import group_percentiles

    cuts = sorted(thresholds)
    level = F.lit(0)
    for i, cut in enumerate(cuts, start=1):
        level = F.when(F.col(n) >= cut, i).otherwise(level)
    rows = (df.select(level.alias("_level"), F.col(value)).filter(F.col("_level") > 0)
            .withColumn("threshold", F.explode(F.slice(
                F.array(*[F.lit(c) for c in cuts]), F.lit(1), F.col("_level")))))
    stats = rows.groupBy("threshold").agg(
        F.count("*").alias("kept"),
        F.avg((F.abs(F.col(value)) > bound).cast("int")).alias("outlier_share"))
    return stats.join(group_percentiles(rows, ["threshold"], value, {"median": 0.5}), "threshold")


def class_weights(train: DataFrame, label: str, out: str = "w") -> DataFrame:
    """Balanced weights from the training prevalence, which is all a model may know."""
    rate = train.agg(F.avg(label).alias("p")).scalar()
    return train.withColumn("_p", rate).withColumn(out, F.when(
        F.col(label) == 1, F.when(F.col("_p") > 0, 1 / (2 * F.col("_p")))).otherwise(
        F.when(F.col("_p") < 1, 1 / (2 * (1 - F.col("_p")))))).drop("_p")


def metrics_long(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    """A run log: (metric, slice, value) rows in one fixed schema."""
    return spark.createDataFrame(
        [(m, s, None if v is None else float(v)) for m, s, v in rows], METRIC_SCHEMA)


def task_scorecard(results: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Every task's score beside its own baseline's: (table, model column, baseline column)."""
    out = None
    for task, (df, model, baseline) in results.items():
        row = df.select(F.lit(task).alias("task"), F.col(baseline).alias("baseline"),
                        F.col(model).alias("model"))
        out = row if out is None else out.unionByName(row)
    return out.withColumn("gain", F.col("model") - F.col("baseline"))
