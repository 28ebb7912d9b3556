"""Segments of fitted clusters: ranks and names follow the profile, not the fit's numbers."""

import pytest
from pyspark.sql import functions as F

from opspark.plans import clustering
from opspark.plans.clustering import View, canonical, segment_entities
from opspark.plans.models import (
    BINS, PIECES, bin_cells, bin_edges, binned, regressor, target_models)


@pytest.fixture(scope="module")
def people(spark):
    """Three clear groups on two axes; the last group has no second view."""
    return spark.range(300).select(
        F.col("id").alias("k"), (F.col("id") % 3 * 100.0 + F.rand(1)).alias("x"),
        ((2 - F.col("id") % 3) * 50.0 + F.rand(2)).alias("y"),
        F.when(F.col("id") % 3 == 2, "no").otherwise("yes").alias("covered"),
        (F.col("id") % 3 == 2).cast("int").alias("lapsed")).persist()


def views(k=3):
    return [View("one", ["x", "y"], k, "x", [("far", "x"), ("tall", "y")], "between"),
            View("two", ["y"], 2, "y", [("tall", "y")], "short", "covered = 'yes'")]


@pytest.mark.parametrize("seed", [1, 42, 99])
def test_labels_do_not_depend_on_the_fit(spark, people, monkeypatch, seed):
    monkeypatch.setattr(clustering, "SEED", seed)
    scores = people.select("k", (F.col("x") / 300).alias("risk")).filter("k <> 7")
    found, profiles = segment_entities(people, views(), ["k"], scores, ["lapsed"])
    rows = {r.k: r for r in found.collect()}
    assert len(rows) == found.count() == 300
    for k, r in rows.items():
        assert (r.one, r.one_name) == {2: (1, "far"), 1: (2, "between"), 0: (3, "tall")}[k % 3]
        assert (r.two, r.two_name) == {2: (None, None), 1: (2, "short"), 0: (1, "tall")}[k % 3]
        assert (r.risk is None) == (k == 7) and r.lapsed == (k % 3 == 2)
    p = profiles["one"].orderBy("rank").collect()
    assert [r.n for r in p] == [100] * 3 and abs(sum(r.share for r in p) - 1) < 1e-9
    assert [r.x for r in p] == sorted((r.x for r in p), reverse=True)


def test_ties_go_to_the_lower_number(spark):
    rows = [(0, 1.0, 5.0), (1, 1.0, 5.0), (2, 3.0, 0.0)]
    labelled = spark.createDataFrame(rows, "c int, x double, y double")
    got = canonical(labelled, "c", View("v", ["x", "y"], 3, "x", [("tall", "y")], "rest"))
    assert [(r.c, r["rank"], r.name) for r in got.orderBy("rank").collect()] == [
        (2, 1, "rest"), (0, 2, "tall"), (1, 3, "rest")]


def test_targets_learn_from_train_rows_only(spark):
    rows = [(s, float(i), 3.0 * i, float(i % 5 - 1), "test" if i % 4 == 0 else "train")
            for i in range(80) for s in ("a", "b")] + [("c", 1.0, 2.0, 1.0, "test")]
    df = spark.createDataFrame(rows, "site string, x double, t double, u double, fold string")
    got = target_models(df, {"t": "t", "u": "u"}, ["x"], "site", "tree", {"tree": (1, 6)}).collect()
    train = {(t, s): [r[i] for r in rows if r[0] == s and r[4] == "train" and r[i] >= 0]
             for t, i in (("t", 2), ("u", 3)) for s in "ab"}
    for r in got:
        known = train.get((r.task, r.site)) or sum((v for k, v in train.items() if k[0] == r.task), [])
        assert abs(r.baseline - sum(known) / len(known)) < 1e-9
        assert min(known) - 1e-9 <= r.pred <= max(train[r.task, "a"]) + 1e-9
    assert len([r for r in got if r.task == "t"]) == 41
    assert len([r for r in got if r.task == "u"]) == 1 + 2 * sum(i % 5 > 0 for i in range(0, 80, 4))
    off = [abs(r.pred - r.truth) for r in got if r.task == "t" and r.site == "a"]
    base = [abs(r.baseline - r.truth) for r in got if r.task == "t" and r.site == "a"]
    assert sum(off) < sum(base) / 5


def test_trees_are_fitted_on_cells_of_all_rows(spark):
    rows = [(float(i % 3), float(i) if i % 50 else None, float(i % 7)) for i in range(4000)]
    df = spark.createDataFrame(rows, "few double, many double, y double").repartition(3).cache()
    edges = bin_edges(df, ["few", "many"])
    assert edges["few"] == [float("-inf"), 1.0, 2.0, float("inf")]
    assert len(edges["many"]) == BINS + 1
    ready = binned(["few", "many"], edges, "features").transform(df)
    cells = bin_cells(ready, "y").collect()
    # 32 bins and one for rows without a value, beside each of three values
    assert len(cells) <= 3 * 33 * PIECES < len(rows)
    assert sum(r.w for r in cells) == len(rows)
    assert abs(sum(r.w * r.y for r in cells) - sum(r[2] for r in rows)) < 1e-6
    seen = sorted(df.filter("many >= 0").select("many").rdd.map(lambda r: r[0]).collect())
    assert seen[0] < edges["many"][1] < edges["many"][-2] <= seen[-1]


def test_a_tree_on_cells_predicts_as_one_on_rows(spark):
    rows = [(float(i % 4), float(i % 9), (i % 4) * 10.0 + (i % 9 > 4) * 3 + i % 2) for i in range(1800)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    ready = binned(["a", "b"], bin_edges(df, ["a", "b"]), "features").transform(df).cache()
    size = {"tree": (1, 3)}
    plain = regressor("tree", size, "y").fit(ready)
    cells = regressor("tree", size, "y", weight="w").fit(bin_cells(ready, "y"))
    one, two = (m.transform(ready.select("features").distinct()).select(
        "features", "prediction").rdd.map(tuple).collectAsMap() for m in (plain, cells))
    assert len(one) == 36 and all(abs(one[k] - two[k]) < 1e-9 for k in one)


def test_predictions_of_a_cell_reach_each_of_its_rows(spark):
    rows = [("a", float(i % 2), float(i % 2), "train") for i in range(40)]
    rows += [("a", float(i % 2), 5.0, "test") for i in range(60)]
    df = spark.createDataFrame(rows, "site string, x double, t double, fold string")
    got = target_models(df, {"t": "t"}, ["x"], "site", "tree", {"tree": (1, 3)}).collect()
    assert sorted(round(r.pred, 6) for r in got) == [0.0] * 30 + [1.0] * 30
