"""K-means plans: sweep k, compare with bisecting k-means, label entities."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opspark.operators.joins import label_pairs
from opspark.operators.segments import agreement, name_by_rules
from opspark.plans.models import as_doubles, numeric_pipeline
from opspark.session import cut, measured

SEED = 42


def prepare(df: DataFrame, cols: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Impute, assemble and standardise once, so a sweep compares clusterings only."""
    prep, _ = numeric_pipeline(cols, scale=True)
    df = as_doubles(df, cols)
    return Pipeline(stages=prep.getStages()).fit(df).transform(df).select(*keep, "features")


def cluster(df: DataFrame, k: int, kind: str = "kmeans", features: str = "features",
            max_iter: int = 50):
    est = {"kmeans": KMeans, "bisecting": BisectingKMeans}[kind]
    return est(featuresCol=features, k=k, seed=SEED, maxIter=max_iter).fit(df)


def silhouette(predicted: DataFrame, features: str = "features") -> float | None:
    """Squared-euclidean silhouette; None where everything fell into one cluster."""
    if predicted.select("prediction").distinct().limit(2).count() < 2:
        return None
    return ClusteringEvaluator(featuresCol=features, predictionCol="prediction",
                               metricName="silhouette").evaluate(predicted)


def sweep_k(df: DataFrame, ks: Sequence[int] = range(2, 9),
            features: str = "features", max_iter: int = 50) -> DataFrame:
    """Silhouette, cost and the share of the largest and smallest cluster for each k.

    ``df`` should be cached: every k reads it several times.
    """
    rows = []
    for k in ks:
        model = cluster(df, k, features=features, max_iter=max_iter)
        sizes = model.summary.clusterSizes
        rows.append((k, silhouette(model.transform(df), features),
                     float(model.summary.trainingCost), len([s for s in sizes if s]),
                     max(sizes) / sum(sizes), min(sizes) / sum(sizes)))
    return df.sparkSession.createDataFrame(
        rows, "k int, silhouette double, cost double, clusters int, "
              "largest_share double, smallest_share double")


def compare(df: DataFrame, k: int, key: Sequence[str], features: str = "features",
            max_iter: int = 50) -> DataFrame:
    """Do two algorithms find the same groups? Silhouettes and agreement, one row.

    A collapsed clustering (fewer than two groups) has no silhouette and is reported so.
    """
    a = cluster(df, k, features=features, max_iter=max_iter).transform(df)
    b = cluster(df, k, "bisecting", features, max_iter).transform(df)
    pairs = label_pairs(a, b, key, "prediction", "prediction")
    sa, sb = silhouette(a, features), silhouette(b, features)
    return agreement(pairs).select(
        F.lit(k).alias("k"), F.lit(sa).cast("double").alias("kmeans_silhouette"),
        F.lit(sb).cast("double").alias("bisecting_silhouette"),
        (F.lit(sb is None)).alias("collapsed"), "agreement", "n")


@dataclass(frozen=True)
class View:
    """One way to look at entities: features, clusters, and how clusters are told apart.

    ``order`` says which mean orders the clusters (the first is the highest); ``rules``
    name them in turn by the highest mean of a column, ``rest`` names the others.
    ``where`` leaves out entities that the view's features say nothing about.
    """

    name: str
    features: Sequence[str]
    k: int
    order: str
    rules: Sequence[tuple[str, str]]
    rest: str
    where: str | None = None  # a condition in SQL


def canonical(labelled: DataFrame, cluster: str, view: View) -> DataFrame:
    """One row per cluster: rank (1 is the highest mean of ``view.order``), name, n, share, means.

    A fit numbers its clusters as it happens to find them. The rank and the name follow
    from the profile, so they mean the same in another fit. Ties go to the lower number.
    """
    profile = labelled.groupBy(cluster).agg(
        F.count("*").alias("n"), *[F.avg(c).alias(c) for c in view.features])
    named = name_by_rules(profile, cluster, view.rules, view.rest)
    # One row per cluster: small windows.
    rank = F.row_number().over(W.orderBy(F.desc_nulls_last(view.order), cluster))
    return named.withColumn("rank", rank).withColumn(
        "share", F.col("n") / F.sum("n").over(W.partitionBy()))


def segment_view(df: DataFrame, view: View, key: Sequence[str],
                 max_iter: int = 50) -> tuple[DataFrame, DataFrame]:
    """(key, segment, segment name of every entity of the view; the clusters' profile)."""
    inside = df if view.where is None else df.filter(view.where)
    ready = cut(prepare(inside, view.features, [*key, *view.features]))
    labelled = cluster(ready, view.k, max_iter=max_iter).transform(ready).drop("features")
    labelled = cut(labelled)
    profile = measured(canonical(labelled, "prediction", view))
    found = labelled.select(*key, "prediction").join(
        profile.select("prediction", F.col("rank").alias(view.name),
                       F.col("name").alias(f"{view.name}_name")), "prediction").drop("prediction")
    return found, profile


def segment_entities(df: DataFrame, views: Sequence[View], key: Sequence[str], scores: DataFrame,
                     keep: Sequence[str], max_iter: int = 50) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(one row per entity: ``keep``, its score and its segment in each view; profiles by view).

    An entity that a view leaves out has null segments there; without a score, a null score.
    """
    out, profiles = df.select(*key, *keep).join(scores, list(key), "left"), {}
    for view in views:
        found, profiles[view.name] = segment_view(df, view, key, max_iter)
        out = out.join(found, list(key), "left")
    return cut(out), profiles
