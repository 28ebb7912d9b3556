"""The spread isotonic fit against a plain one."""

import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from opspark.operators.isotonic import apply_pools, isotonic_pools


def plain(rows):
    """Pools by the minimax form over distinct points."""
    points = {}
    for x, y in rows:
        if x is not None and y is not None:
            s, n = points.get(x, (0, 0))
            points[x] = s + y, n + 1
    xs = sorted(points)
    fit = [max(min(sum(points[x][0] for x in xs[a:b]) / sum(points[x][1] for x in xs[a:b])
                   for b in range(i + 1, len(xs) + 1)) for a in range(i + 1)) for i in range(len(xs))]
    pools = []
    for x, v in zip(xs, fit):
        if pools and abs(pools[-1][2] - v) < 1e-12:
            pools[-1][1] = x
        else:
            pools.append([x, x, v])
    return pools


def cases():
    rng = random.Random(3)
    yield [(rng.random(), float(rng.random() < 0.4)) for _ in range(60)]
    yield [(float(rng.randrange(12)), float(rng.randrange(2))) for _ in range(150)]  # ties
    yield [(float(i), float(-i)) for i in range(50)]  # one pool in the end
    yield [(float(i), float(i)) for i in range(40)] + [(100.0, -500.0)]  # the last point takes many
    yield [(1.0, 1.0), (None, 0.0), (2.0, None)]
    yield []


@pytest.mark.parametrize("rows", list(cases()))
@pytest.mark.parametrize("block", [1_000_000, 5])
def test_pools_equal_the_minimax_fit(spark, rows, block):
    df = spark.createDataFrame(rows, "x double, y double").repartition(3)
    got = [(r.lo, r.hi, r.value) for r in isotonic_pools(df, "x", "y", block).orderBy("lo").collect()]
    want = plain(rows)
    assert [g[:2] for g in got] == [tuple(w[:2]) for w in want]
    assert all(abs(g[2] - w[2]) < 1e-12 for g, w in zip(got, want))


def test_values_between_pools_equal_the_librarys(spark):
    rng = random.Random(7)
    df = spark.createDataFrame([(rng.random(), float(rng.random() < 0.3)) for _ in range(400)],
                               "x double, y double")
    new = spark.createDataFrame([(rng.uniform(-0.2, 1.2), "k") for _ in range(100)]
                                + [(r.x, "k") for r in df.limit(50).collect()] + [(0.5, "k")] * 3,
                                "x double, _x string").select("x")
    vector = VectorAssembler(inputCols=["x"], outputCol="v")
    model = IsotonicRegression(featuresCol="v", labelCol="y", predictionCol="want").fit(vector.transform(df))
    both = apply_pools(model.transform(vector.transform(new)), isotonic_pools(df, "x", "y", 30), "x", "got")
    rows = both.select("want", "got").collect()
    assert len(rows) == 153 and all(abs(r.want - r.got) < 1e-9 for r in rows)


def test_nulls_and_no_pools(spark):
    df = spark.createDataFrame([(None,), (1.0,)], "x double")
    none = isotonic_pools(df.filter("x > 5"), "x", F.lit(1.0))
    assert [r.p for r in apply_pools(df, none, "x", "p").collect()] == [None, None]
    one = isotonic_pools(df, "x", F.lit(1.0))
    assert sorted(map(repr, (r.p for r in apply_pools(df, one, "x", "p").collect()))) == ["1.0", "None"]
