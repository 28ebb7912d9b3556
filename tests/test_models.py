"""Model plans on a small separable table."""

import pytest
from pyspark.sql import functions as F

from opspark.workload.model_queries import CORE, LEAKS, RICH, SITES, _features
from opspark.operators.metrics import class_weights
from opspark.operators.quality import null_indicators
from opspark.operators.ranking import rank_auc
from opspark.operators.split import hash_fold
from opspark.plans.calibration import calibrate
from opspark.plans.clustering import compare, prepare, sweep_k
from opspark.plans.models import (
    assert_no_leak, fit_classifier, importance, score, scorecard, side_by_side)
from opspark.session import LEAST_ROWS, packed


SMALL_SIZE = {"gbt": (5, 3), "forest": (8, 4), "tree": (1, 4)}  # for the tests' speed


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(600).select(
        F.col("id").alias("k"), ((F.col("id") * 37) % 101).cast("double").alias("x"),
        F.when(F.col("id") % 10 != 0, ((F.col("id") * 53) % 97).cast("double")).alias("z"))
    df = df.withColumn("label", ((F.col("x") + F.coalesce("z", F.lit(0.0)) / 4) > 60)
                       .cast("double")).withColumn("site", F.when(F.col("k") % 2 == 0, "a")
                                                   .otherwise("b"))
    return hash_fold(df, ["k"]).persist()


@pytest.mark.parametrize("kind", ["logistic", "tree", "forest", "gbt"])
def test_classifiers_rank_well(table, kind):
    df, indicators = null_indicators(table, ["x", "z"])
    assert indicators == ["z_missing"]
    model, slots = fit_classifier(df.filter("fold = 'train'"), kind, ["x", "z"], indicators,
                                  size=SMALL_SIZE, forbidden=["site"])
    scored = score(model, df.filter("fold = 'test'"), ["k", "site", "label"])
    assert rank_auc(scored, "label", "risk", ["k"]).first()["roc_auc"] > 0.9
    weights = {r["feature"]: abs(r["weight"]) for r in importance(model, slots, df).collect()}
    assert max(weights, key=weights.get) == "x_i"
    if kind == "logistic":
        card = scorecard(scored, "label", "risk", ["k"], "site")
        assert {r["slice"] for r in card.filter("metric = 'site_roc_auc'").collect()} == {"a", "b"}


def test_leaks_are_refused(table):
    with pytest.raises(ValueError):
        fit_classifier(table, "tree", ["x"], forbidden=["x"])
    assert_no_leak(CORE + RICH, LEAKS)


def test_class_weights_balance(table):
    w = class_weights(table, "label").groupBy("label").agg(F.sum("w").alias("s")).collect()
    assert abs(w[0]["s"] - w[1]["s"]) < 1e-6


def test_isotonic_only_when_needed(table):
    for tol, chosen in ((1.0, "unweighted"), (0.0, "isotonic")):
        df, report = calibrate(table.fillna(0.0), "label", ["k"], ["x", "z"], tol=tol,
                               size=SMALL_SIZE, bins=5, forbidden=[])
        stages = [r["stage"] for r in report.collect()]
        assert stages == ["weighted", "unweighted", f"{chosen} train", f"{chosen} test"]
        assert df.filter("risk_cal between 0 and 1").count() == 600


def test_clusters(spark):
    df = spark.range(300).select("id", (F.col("id") % 3 * 10.0 + F.col("id") % 7 * .01).alias("a"),
                                 (F.col("id") % 3 * -5.0).alias("b"))
    p = prepare(df, ["a", "b"], ["id"]).persist()
    s = {r["k"]: r for r in sweep_k(p, [2, 3]).collect()}
    assert s[3]["silhouette"] > .99 and s[3]["clusters"] == 3 and s[3]["cost"] < s[2]["cost"]
    c = compare(p, 3, ["id"]).first()
    assert c["agreement"] == 1.0 and not c["collapsed"]
    one = spark.range(20).select("id", F.lit(1.0).alias("a"), F.lit(2.0).alias("b"))
    assert compare(prepare(one, ["a", "b"], ["id"]), 2, ["id"]).first()["collapsed"]


def test_jobs_run_at_once_and_answer_in_order(table):
    from threading import Barrier

    both = Barrier(2)  # passed only if the two jobs run at the same time

    def job(side):
        both.wait(60)
        return table.filter(F.col("site") == side).count()

    assert side_by_side(table, [lambda: job("a"), lambda: job("b")]) == [300, 300]
    assert side_by_side(table, []) == []


def test_fits_read_few_partitions(spark, tmp_path):
    """A fit's table has the partitions that its rows call for, not those of the shuffle before it."""
    ts = F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 30 * 86400 + F.col("id") % 23 * 3600)
    spark.range(6000).select(
        F.col("id").alias("event_id"), ts.alias("ts"), (F.col("id") % 37).alias("user_id"),
        F.element_at(F.array(*map(F.lit, SITES)), (F.col("id") % 5 + 1).cast("int")).alias("event_type"),
        (F.col("id") % 91).cast("double").alias("value"),
        F.concat(F.lit('{"k": '), (F.col("id") % 97).cast("string"), F.lit("}")).alias("props")
    ).write.parquet(str(tmp_path / "events.parquet"))
    g, _, _ = _features(spark, str(tmp_path), CORE)
    assert g.count() == 185 and g.rdd.getNumPartitions() == 1
    cores = spark.sparkContext.defaultParallelism
    for rows, parts in ((0, 1), (LEAST_ROWS - 1, 1), (3 * LEAST_ROWS, min(3, cores)),
                        (2 * cores * LEAST_ROWS, cores)):
        df = packed(spark.range(0, rows, 1, 50))
        assert df.rdd.getNumPartitions() == parts
        assert df.agg(F.count("*"), F.sum("id")).first() == (rows, sum(range(rows)) if rows else None)
