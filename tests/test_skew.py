"""One key owns a third of the rows: the split plans give the plain plans' results."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from opspark.operators.activity import site_window
from opspark.operators.attribute import attribute_fee, contribution_share
from opspark.operators.estimate import apply_cells, fit_cells
from opspark.operators.joins import drop_colliding, hot_keys, lookup_join, seat_join, skew_join
from opspark.operators.replay import return_excess


@pytest.fixture(scope="module")
def parts(spark):
    """3,000 rows, 1,000 of them in transaction 0."""
    i = F.col("id")
    return spark.range(3000).select(
        F.when(i % 3 == 0, 0).otherwise(i % 400 + 1).alias("txn"), i.alias("actor"),
        ((i * 7919) % 1000).alias("paid"))


@pytest.fixture(scope="module")
def txns(parts):
    t = F.col("txn")
    return parts.select("txn").distinct().withColumns({
        "site": F.when(t % 2 == 0, "a").otherwise("b"), "day": (t % 20 + 1).cast("int"),
        "used": t % 17 + 1, "seen": F.when(t % 5 != 0, t % 17 + 1)})


def test_one_hot_key_is_found(parts):
    assert rows(hot_keys(parts, ["txn"], 500)) == [(0,)]


def test_joins(parts, txns):
    want = rows(parts.join(txns, "txn"), "txn", "actor", "site")
    hot = hot_keys(parts, ["txn"], 500)
    assert rows(skew_join(parts, txns, ["txn"], hot=hot), "txn", "actor", "site") == want
    joined = seat_join(parts, txns, "txn", ["actor"], ["site"], hot_rows=500)
    assert rows(joined, "txn", "actor", "site") == want
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "BroadcastHashJoin" in plan


def test_large_lookup_splits_hot_keys(parts, txns, monkeypatch):
    import opspark.operators.joins as joins

    want = rows(parts.join(txns.filter("txn > 5"), ["txn"], "left"), "txn", "actor", "site")
    got = lookup_join(parts, txns.filter("txn > 5"), ["txn"], "left", hot_rows=500)
    assert rows(got, "txn", "actor", "site") == want


@pytest.mark.parametrize("op", [
    lambda p, hot: contribution_share(p, "txn", "paid", hot_rows=hot),
    lambda p, hot: return_excess(p, "txn", "actor", "paid", hot_rows=hot)])
def test_per_transaction_figures(parts, op):
    assert rows(op(parts, 500)) == rows(op(parts, 10_000))


def test_attribution(parts, txns):
    totals = parts.groupBy("txn").agg(F.sum("paid").alias("whole"), F.count("*").alias("n"))
    full = txns.join(totals, "txn").persist()

    def run(hot):
        out = attribute_fee(parts, full, "txn", ["site", "actor"], "paid",
                            {"": "used", "_observed": "seen"}, "whole", "n", "day",
                            site_window(full, "site", "day"), hot_rows=hot)
        return [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows(out)]

    assert run(500) == run(10_000)


def test_colliding_hot_key(parts):
    (clean,), report = drop_colliding(parts, ["txn"], hot_rows=500)
    (plain,), same = drop_colliding(parts, ["txn"])
    assert rows(clean) == rows(plain) and rows(report) == rows(same)


def test_cells(parts):
    keys = [["txn", "a"], ["a"]]
    df = parts.withColumn("a", F.col("actor") % 2).withColumn("fee", F.col("paid") / 10)
    cells = fit_cells(df.filter("actor % 7 = 0"), "fee", keys)
    got = rows(apply_cells(df, cells, keys, 3, hot_rows=500), "actor", "est", "level")
    assert got == rows(apply_cells(df, cells, keys, 3), "actor", "est", "level")


def test_wide_aggregate_is_a_hash_aggregate(spark, sf):
    from opspark.operators.activity import collapse, entity_figures, site_window
    from opspark.workload.bindings import PRIOR, act

    rows = act(spark, sf)
    window = site_window(rows, "site", "day")
    for df in (collapse(rows, PRIOR, window), entity_figures(rows, PRIOR, window)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan
        assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
