"""The block form of a running measure gives what a window gives."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from opspark.operators.rollup import group_percentiles, summary_stats
from opspark.operators.scan import Measure, blocked, hot_keys, running, windowed

MEASURES = [
    Measure("n", "count"), Measure("n_before", "count", inclusive=False),
    Measure("s", "sum", "v"), Measure("s_before", "sum", "v", inclusive=False),
    Measure("top", "max", "v"), Measure("top_before", "max", "v", inclusive=False),
    Measure("low", "min", "v"), Measure("seen", "last", "w"),
    Measure("seen_before", "last", "w", inclusive=False),
    Measure("all_n", "count", total=True), Measure("all_s", "sum", "v", total=True),
]


def sample(spark, seed, n=300):
    rng = random.Random(seed)
    data = [(rng.choice(["a", "a", "a", "b", None]), i, rng.choice([None, rng.randrange(50)]),
             rng.choice([None, None, rng.randrange(9)])) for i in range(n)]
    return spark.createDataFrame(data, "g string, i int, v int, w int")


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("seed", [1, 2])
def test_blocks_equal_windows(spark, by, seed):
    df = sample(spark, seed)
    want = rows(windowed(df, by, ["i"], MEASURES))
    assert rows(blocked(df, by, ["i"], MEASURES, blocks=5)) == want
    assert rows(running(df, ["i"], MEASURES, by, hot_rows=100, blocks=4)) == want


def test_only_the_large_groups_are_hot(spark):
    df = sample(spark, 3)
    hot = {r[0] for r in hot_keys(df, ["g"], 100).collect()}
    counts = {r[0]: r[1] for r in df.groupBy("g").count().collect()}
    assert hot == {g for g, n in counts.items() if n > 100} and hot
    assert hot_keys(df, ["g"], 1000) is None


def test_ties_spread_over_blocks(spark):
    """One value owning all rows does not end up in one block: the key splits it."""
    df = spark.range(2000).select(F.lit(0.5).alias("p"), F.col("id").alias("k"))
    out = blocked(df, [], [F.desc("p"), "k"], [Measure("n", "count")], blocks=8)
    got = rows(out, "k", "n")
    assert [r[1] for r in sorted(got)] == list(range(1, 2001))


def test_block_plan_has_no_single_task_window(spark):
    df = sample(spark, 4)
    plan = blocked(df, [], ["i"], [Measure("n", "count")], 4)._jdf.queryExecution().toString()
    window_lines = [x for x in plan.splitlines() if "Window [" in x and "_in_n" in x]
    assert window_lines and all("_block" in x for x in window_lines)


@pytest.mark.parametrize("hot", [10, 10_000])
def test_percentiles_match_sorting(spark, hot):
    rng = random.Random(7)
    data = [(rng.choice("xyz"), float(rng.randrange(40))) for _ in range(500)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r["g"]: r for r in group_percentiles(
        df, ["g"], "v", {"p0": 0, "p10": 0.1, "p50": 0.5, "p90": 0.9, "p100": 1}, hot_rows=hot)
        .collect()}
    for g in "xyz":
        vs = sorted(v for k, v in data if k == g)
        for name, p in (("p0", 0), ("p10", .1), ("p50", .5), ("p90", .9), ("p100", 1)):
            at = max(-(-round(p * len(vs) * 10) // 10), 1)
            assert got[g][name] == vs[at - 1]


def test_summary_and_sketch(spark):
    df = spark.range(1, 101).select(F.col("id").cast("double").alias("v"))
    (r,) = summary_stats(df, ["v"], room=10).collect()
    assert (r["min"], r["p25"], r["p50"], r["p75"], r["max"]) == (1, 25, 50, 75, 100)
    (a,) = group_percentiles(df.withColumn("g", F.lit(1)), ["g"], "v", {"m": .5},
                             exact=False).collect()
    assert a["m"] == 50


def test_blocks_grow_with_the_rows(spark, monkeypatch):
    from opspark.operators import scan

    df = spark.range(10).toDF("id")
    assert scan.blocks_for(10**6, df) is None
    assert scan.blocks_for(10**11, df) == 10**11 // scan.BLOCK_ROWS
    monkeypatch.setattr(scan, "BLOCK_ROWS", 10)
    out = scan.running(spark.range(500).toDF("id"), ["id"], [scan.Measure("s", "sum", "id")])
    assert [r["s"] for r in out.orderBy("id").collect()] == [i * (i + 1) // 2 for i in range(500)]


def test_joins_on_a_nearly_unique_key_count_nothing(spark):
    from opspark.operators.joins import seat_join

    df = spark.range(10).selectExpr("id AS txn", "id AS a")
    plan = seat_join(df, df, "txn", ["a"], [])._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan
