"""Exact selection and the budgets that use it, against sorted lists."""

import math
import random

import pytest

from opspark.operators.ranking import budget_curve, group_budgets
from opspark.operators.selection import column_percentiles, order_statistics


def columns():
    rng = random.Random(1)
    rows = []
    for i in range(3000):
        x = rng.gauss(0, 1e6)
        rows.append((x if i % 50 else None, rng.randrange(5), float(int(x) % 7) if i % 3 else 1e300,
                     None, rng.choice([0.0, -math.inf, math.inf])))
    return rows


@pytest.mark.parametrize("room,accuracy", [(200_000, 10_000), (20, 50), (1, 10)])
def test_ranks_equal_the_sorted_list(spark, room, accuracy):
    rows, names = columns(), "abcde"
    df = spark.createDataFrame(rows, "a double, b int, c double, d double, e double").repartition(5)
    ranks = [1, 2, 7, 100, 1499, 1500, 2400, 2999, 3000, 3001]
    got = order_statistics(df, {c: ranks for c in names}, room, accuracy)
    want = {}
    for i, c in enumerate(names):
        values = sorted(r[i] for r in rows if r[i] is not None)
        want.update({(c, k): values[k - 1] for k in ranks if k <= len(values)})
    assert got == want


def test_percentiles_are_discrete_and_a_column_without_values_has_no_row(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (4.0, None), (None, None)], "x double, y double")
    points = {"low": 0.0, "mid": 0.5, "third": 0.3333, "high": 1.0}
    assert [tuple(r) for r in column_percentiles(df, ["x", "y"], points).collect()] == [
        ("x", 1.0, 2.0, 1.0, 4.0)]
    assert column_percentiles(df.limit(0), ["x"], points).count() == 0


@pytest.mark.parametrize("levels", [3, 10**6])
def test_budgets_equal_a_full_ranking(spark, levels):
    rng = random.Random(levels)
    rows = [(rng.randrange(2), rng.randrange(levels) / 7 if i % 9 else None, i) for i in range(700)]
    df = spark.createDataFrame(rows, "y int, p double, k int").repartition(4)
    ranked = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
    budgets = [0.001, 0.1, 0.33, 0.9, 0.97, 1.0]
    for r in budget_curve(df, "y", "p", ["k"], budgets).collect():
        k = max(1, math.floor(r.budget * 700 + 0.5))
        assert (r.contacted, r.hits) == (k, sum(x[0] for x in ranked[:k]))


@pytest.mark.parametrize("hot", [10, 10_000])
def test_budgets_of_every_group_in_one_pass(spark, hot):
    rng = random.Random(5)
    rows = [("a" if i % 3 else "b" if i % 2 else None, rng.randrange(2), rng.randrange(9) / 7, i)
            for i in range(300)] + [("lone", 0, 0.5, 999)]
    df = spark.createDataFrame(rows, "g string, y int, p double, k int").repartition(4)
    got = group_budgets(df, "y", "p", ["k"], ["g"], [0.1, 0.5, 1.0], hot).collect()
    assert len(got) == 12
    for r in got:
        mine = sorted((x for x in rows if x[0] == r.g), key=lambda x: (-x[2], x[3]))
        k = max(1, math.floor(r.budget * len(mine) + 0.5))
        hits, positives = sum(x[1] for x in mine[:k]), sum(x[1] for x in mine)
        assert (r.contacted, r.hits, r.precision) == (k, hits, hits / k)
        assert r.recall == (hits / positives if positives else None)
