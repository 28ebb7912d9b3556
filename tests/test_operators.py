"""Features, quality, estimates, rankings on small fixtures worked out by hand."""

import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from opspark.functions.columns import band, finite, invert_log, plausible, widening_bucket
from opspark.operators import activity
from opspark.operators.activity import entity_figures, feature_table, site_window
from opspark.operators.benchmark import reduce_counts
from opspark.operators.checks import check_attribution, check_counts, check_reconcile
from opspark.operators.concurrency import concurrency, distinct_resources, resource_use
from opspark.operators.estimate import apply_cells, fit_cells
from opspark.operators.joins import checked_join, drop_colliding, group_mean_baseline
from opspark.operators.metrics import confusion, metrics_long, skill, threshold_sweep
from opspark.operators.modal import dominant_categories, latest_per_key, modal_value
from opspark.operators.quality import (
    guard_finite, null_unrecorded, one_hot, quality_status, quarantine, recorded_flags)
from opspark.operators.ranking import (
    best_f1, bin_of, budget_curve, list_overlap, rank_auc, ranking_comparison, reach_curve,
    reliability, roc_auc)
from opspark.operators.segments import agreement, name_by_rules, nearest_prototype
from opspark.operators.split import hash_fold, population_report
from opspark.operators.value import naive_value, sensitivity
from opspark.workload.bindings import LIFETIME, PRIOR, act


def seats(spark, data):
    """(site, player, day) rows with everything else filled in."""
    df = spark.createDataFrame(data, "site string, player string, day int")
    fill = {"stake": 1, "seats": 4, "invested": 10, "bucket": 1, "resource": 1, "net": 5,
            "bets": 1, "calls": 2}
    flags = {"money_ok": True, "voluntary": True, "raised": False, "folded": False,
             "showed": False, "forced": False, "closing": False}
    return df.withColumns({k: F.lit(v) for k, v in {**fill, **flags}.items()}).withColumn(
        "stack", F.lit(100.0))


F2 = [("X", "u", 1), ("X", "u", 13), ("X", "u", 14), ("X", "v", 5), ("X", "v", 6),
      ("X", "w", 20), ("Y", "z", 26), ("Y", "z", 19)]


def test_windows_are_per_site(spark):
    df = seats(spark, F2)
    assert rows(site_window(df, "site", "day"), "site", "site_last_day", "cutoff") == [
        ("X", 20, 13), ("Y", 26, 19)]
    g = {r["player"]: r for r in feature_table(df, PRIOR, "p_rows", 1).collect()}
    assert set(g) == {"u", "v", "z"}
    u, v, z = g["u"], g["v"], g["z"]
    assert (u["p_rows"], u["p_recency_days"], u["p_tenure_days"], u["p_rows_w1"], u["p_rows_w2"],
            u["p_rows_last3"], u["p_late_share"], u["lapsed"]) == (2, 0, 13, 1, 1, 1, 0.5, 0)
    assert (v["p_rows"], v["p_recency_days"], v["p_tenure_days"], v["p_rows_w1"], v["p_rows_w2"],
            v["lapsed"]) == (2, 7, 9, 0, 2, 1)
    assert (z["p_rows"], z["p_recency_days"], z["lapsed"]) == (1, 0, 0)


@pytest.mark.parametrize("days", [[1, 65, 66], list(range(1, 366, 3)), [400]])
def test_any_number_of_days(spark, days):
    df = seats(spark, [("X", "u", d) for d in days] + [("X", "w", max(days) + 7)])
    (r,) = feature_table(df, PRIOR, "p_rows", 1).filter("player = 'u'").collect()
    assert (r["p_days_active"], r["p_rows"]) == (len(days), len(days))
    (r,) = feature_table(df, LIFETIME, "rows", 1).filter("player = 'u'").collect()
    assert (r["days_active"], r["span_days"]) == (len(days), max(days) - min(days) + 1)


def test_roles_come_from_the_declarations():
    leaks = set(PRIOR.later())
    assert {"label_rows", "lapsed", "site_last_day"} <= leaks
    assert not leaks & {*PRIOR.tagged("core"), *PRIOR.tagged("rich")}
    assert {"rows", "days_active", "days_since_last", "money_coverage"} <= set(LIFETIME.later())


def test_the_log_is_read_twice(spark, sf, monkeypatch):
    reads = []

    def count(name):
        real = getattr(activity, name)

        def spy(df, *rest):
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            reads.append(plan.count("Relation [event_id"))
            return real(df, *rest)
        return spy

    for name in ("measured", "stored"):
        monkeypatch.setattr(activity, name, count(name))
    out = feature_table(act(spark, sf), PRIOR, "p_rows", 5)
    assert sum(reads) <= 2 + 1  # the window, the collapse and the stored window it joins
    assert "Relation [event_id" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_population_rules_differ(spark):
    core = entity_figures(seats(spark, F2), PRIOR)
    (r,) = population_report(core, "p_rows", "label_rows", 3).collect()
    assert (r["seen"], r["kept"], r["kept_by_lifetime"], r["leaked"]) == (3, 0, 1, 1)


def test_quality_statuses(spark):
    df = spark.createDataFrame([(1, .5, 2, 3.), (2, None, 0, None), (3, None, 2, 0.),
                                (4, None, 2, 3.), (5, None, None, None)],
                               "id int, fee double, n int, s double")
    want = ["ok", "absent", "all_zero", "unreconciled", "unreconciled"]
    assert [r["status"] for r in quality_status(df, "fee", "n", "s").orderBy("id").collect()] == want
    named = quality_status(df, "fee", "n", "s", name_no_rows=True).orderBy("id").collect()
    assert named[4]["status"] == "no_rows" and named[0]["usable"]


def test_guards_and_flags(spark):
    df = spark.createDataFrame([("a", 100., 1), ("a", math.inf, 2), ("a", math.nan, 3),
                                ("b", None, 9), ("b", -math.inf, 9)],
                               "site string, x double, t int")
    assert df.select(F.avg(finite("x"))).first()[0] == 100.0
    assert guard_finite(df, ["x"]).filter("x is not null").count() == 1
    flags = recorded_flags(df, "site", "t")
    out = null_unrecorded(df.select("site", "t"), flags, "site", ["t"])
    assert rows(out.filter("site = 'b'"), "t", "recorded") == [(None, False), (None, False)]
    good, bad = quarantine(df, [("no_value", F.col("x").isNull()), ("late", F.col("t") > 8)])
    assert good.count() + bad.count() == 5 and rows(bad, "reason") == [("late",), ("no_value",)]


def test_column_helpers(spark):
    df = spark.createDataFrame([(0.5,), (19.9,), (20.0,), (49.0,), (999.0,), (1e6,), (None,)],
                               "x double")
    assert [r[0] for r in df.select(widening_bucket("x")).collect()] == [
        0, 19, 20, 30, 500, 1000, None]
    assert [r[0] for r in df.select(band("x", [500, 19.95], ["h", "m", "l"])).collect()] == [
        "l", "l", "m", "m", "h", "h", "l"]
    p = spark.createDataFrame([(6.0, 100.0), (6.1, 100.0), (None, 1.0), (0.0, -1.0), (1.0, None)],
                              "f double, t double")
    assert [r[0] for r in p.select(plausible("f", "t")).collect()] == [
        True, False, False, True, False]
    (r,) = spark.range(1).select(invert_log(F.lit(50.0), 0.0, math.log1p(9.0))).collect()
    assert round(r[0], 9) == 9




def test_one_hot_takes_any_number_of_levels(spark):
    df = spark.range(40).select((F.col("id") % 20).alias("v"))
    out, names = one_hot(df, "v", "3")
    assert len(names) == 19 and out.select(F.sum("v_7")).first()[0] == 2.0
    _, named = one_hot(df, "v", "3", levels=["3", "4"])
    assert named == ["v_4"]


CELLS = [["site", "unit", "flag", "bin"], ["site", "flag", "bin"], ["flag", "bin"]]


def test_fallback_cells(spark):
    seen = spark.createDataFrame([("s1", 1, True, 5, .2), ("s1", 1, True, 5, .4),
                                  ("s1", 2, True, 5, .6)],
                                 "site string, unit int, flag boolean, bin int, fee double")
    todo = spark.createDataFrame([("s1", 1, True, 5), ("s1", 2, True, 5), ("s2", 1, True, 5),
                                  ("s2", 1, False, 9)],
                                 "site string, unit int, flag boolean, bin int")
    out = apply_cells(todo, fit_cells(seen, "fee", CELLS), CELLS, min_n=2)
    got = {(r["site"], r["unit"], r["flag"]): (round(r["est"], 9), r["level"])
           for r in out.collect()}
    assert got == {("s1", 1, True): (.3, 1), ("s1", 2, True): (.4, 2), ("s2", 1, True): (.4, 3),
                   ("s2", 1, False): (0.0, 3)}


def calibration(spark):
    return spark.createDataFrame(list(zip("abcdefg", (.1, .2, .3, .4, .5, .6, .7),
                                          (0, 0, 1, 0, 1, 1, 1))), "id string, p double, y int")


def test_calibration_bins(spark):
    table, summary = reliability(calibration(spark), "y", "p", ["id"], 3)
    t = table.orderBy("bin").collect()
    assert [r["n"] for r in t] == [3, 2, 2]
    assert [round(r["deviation"], 4) for r in t] == [-0.1333, -0.05, -0.35]
    s = summary.first()
    assert round(s["max_abs_deviation"], 9) == .35 and round(s["ece"], 9) == round(1.2 / 7, 9)
    assert round(s["brier"], 9) == round(1.2 / 7, 9)
    r = rank_auc(calibration(spark), "y", "p", ["id"]).first()
    assert round(r["roc_auc"], 9) == round(11 / 12, 9) and round(r["avg_precision"], 9) == .95


def test_bin_sizes_are_ntile_sizes(spark):
    for n, bins in ((7, 3), (10, 10), (3, 5), (23, 4)):
        got = spark.range(1, n + 1).select(bin_of(F.col("id"), F.lit(n), bins).alias("b"))
        want = [b + 1 for b in range(bins) for _ in range(n // bins + (b < n % bins))]
        assert [r["b"] for r in got.collect()] == want


def test_auc_under_ties_equals_mllib(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df = spark.range(400).select(F.col("id").alias("k"), ((F.col("id") * 7919) % 11 / 10).alias("p"),
                                 ((F.col("id") * 104729) % 3 == 0).cast("int").alias("y"),
                                 (F.col("id") % 2).alias("g"))
    got = rank_auc(df, "y", "p", ["k"]).first()["roc_auc"]
    ev = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="p",
                                       metricName="areaUnderROC")
    assert abs(got - ev.evaluate(df)) < 1e-9
    assert abs(roc_auc(df, "y", "p").first()["roc_auc"] - got) < 1e-12
    for hot in (50, 10_000):
        per = {r["g"]: r["roc_auc"] for r in rank_auc(df, "y", "p", ["k"], ["g"], hot).collect()}
        for g in (0, 1):
            assert abs(per[g] - ev.evaluate(df.filter(F.col("g") == g))) < 1e-9


def f6(spark):
    df = spark.createDataFrame([("a", .9, 1.), ("b", .5, 10.), ("c", .2, 20.), ("d", .8, 5.),
                                ("e", .1, 2.)], "id string, risk double, value double")
    return df.withColumn("loss", F.col("risk") * F.col("value")).withColumn("y", F.lit(1))


def test_rankings(spark):
    orders = {"loss": "loss", "risk": "risk", "value": "value"}
    got = {r["ranked_by"]: r for r in ranking_comparison(
        f6(spark), orders, ["id"], "loss", "value", "y", 0.4).collect()}
    assert {n: (round(r["reached"], 6), r["overlap"]) for n, r in got.items()} == {
        "loss": (9.0, 1.0), "risk": (4.9, 0.0), "value": (9.0, 1.0)}
    assert round(got["loss"]["share_of_total"], 6) == round(9 / 14.1, 6)
    (o,) = list_overlap(f6(spark), "loss", "risk", ["id"], 2).collect()
    assert o["shared"] == 0
    curve = reach_curve(f6(spark), "loss", ["id"], "loss", points=6).orderBy("point").collect()
    assert [r["depth"] for r in curve] == [0, 1, 2, 3, 4, 5]
    assert [round(r["reached"], 6) for r in curve] == [0.0, 5.0, 9.0, 13.0, 13.9, 14.1]


def test_budget_and_cut_point(spark):
    b = {r["budget"]: r for r in budget_curve(calibration(spark), "y", "p", ["id"],
                                              (0.01, 0.5)).collect()}
    assert (b[.01]["contacted"], b[.01]["hits"]) == (1, 1)
    assert (b[.5]["contacted"], b[.5]["hits"], b[.5]["recall"]) == (4, 3, .75)
    best = best_f1(calibration(spark), "y", "p").first()
    assert best["threshold"] == .21 and round(best["f1"], 6) == round(8 / 9, 6)


def test_concurrency(spark):
    df = spark.createDataFrame([("a", 1, "t1"), ("a", 1, "t2"), ("a", 1, "t2"), ("a", 2, "t1"),
                                ("a", 3, None), ("b", 1, None)], "e string, m int, t string")
    assert rows(concurrency(df, ["e"], "m", "t")) == [("a", 2, 1.5)]
    assert rows(distinct_resources(df, ["e"], "t", "m")) == [("a", 3, 2), ("b", 1, None)]
    assert rows(resource_use(df, ["e"], "m", "t"), "e", "max_resources", "avg_resources",
                "active_buckets", "distinct_resources") == [
        ("a", 2, 1.5, 3, 2), ("b", None, None, 1, None)]


def test_modal_latest_dominant(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 5), ("a", 5), ("b", 2)], "e string, v int")
    assert rows(modal_value(df, ["e"], "v")) == [("a", 5, 2, 4, 2), ("b", 2, 1, 1, 1)]
    assert rows(dominant_categories(df, "e", "v", 1)) == [("a", "1 (2)"), ("b", "2 (1)")]
    top = latest_per_key(df, ["e"], [F.desc("v")], 1)
    assert rows(top) == [("a", 5, 1), ("b", 2, 1)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_joins_and_checks(spark):
    a = spark.createDataFrame([(1, 10), (1, 11), (2, 12), (3, 13)], "k int, v int")
    b = spark.createDataFrame([(1, 1.), (2, 2.)], "k int, w double")
    (clean, other), report = drop_colliding(a, ["k"], b)
    assert rows(clean) == [(2, 12), (3, 13)] and rows(other) == [(2, 2.0)]
    assert rows(report) == [(1, 2)]
    _, checks = checked_join(a.filter("k > 1"), b, ["k"], ["w"])
    assert rows(checks, "check", "got", "want", "ok") == [("null w", 1, 0, False),
                                                          ("rows", 2, 2, True)]
    diff = check_counts(a.groupBy("k").agg(F.sum("v").alias("s")),
                        a.groupBy("k").agg(F.max("v").alias("t")), ["k"], {"s": "t"})
    assert rows(diff, "got", "ok") == [(1, False)]
    both = check_reconcile(b, b.withColumn("w", F.col("w") + 1e-9), ["k"], "w")
    assert all(r["ok"] for r in both.collect())
    (c,) = check_attribution(b.select(F.col("w").alias("all_fee"),
                                      (F.col("w") * 2).alias("all_fee_equal"))).collect()
    assert not c["ok"]


def test_metrics(spark):
    df = spark.createDataFrame([(1, 1, 2., 2., 1.), (0, 1, 4., 3., 3.), (0, 0, 6., 4., 5.)],
                               "y int, p int, t double, b double, m double")
    c = confusion(df, "y", "p").first()
    assert (c["tp"], c["fp"], c["tn"], c["fn"], c["recall"]) == (1, 1, 1, 0, 1.0)
    s = skill(df, "t", "b", "m").first()
    assert round(s["skill"], 6) == round(1 - 3 / 5, 6) and s["mae"] == 1.0
    got = rows(threshold_sweep(df.withColumn("n", F.col("t").cast("int")), "n", "t", [3, 5], 5),
               "threshold", "kept", "median", "outlier_share")
    assert got == [(3, 2, 4.0, .5), (5, 1, 6.0, 1.0)]
    base = group_mean_baseline(df.filter("y = 0"), df, ["p"], "t")
    assert rows(base, "t", "baseline") == [(2.0, 4.0), (4.0, 4.0), (6.0, 6.0)]
    assert metrics_long(spark, [("auc", None, .5)]).first()["value"] == .5


def test_segments(spark):
    pairs = spark.createDataFrame([(0, 0), (0, 0), (1, 0), (1, 1)], "a int, b int")
    assert agreement(pairs).first()["agreement"] == .75
    prof = spark.createDataFrame([(0, 9., 1.), (1, 5., 8.), (2, 1., 2.)],
                                 "c int, x double, y double")
    named = name_by_rules(prof, "c", [("top", "x"), ("next", "y")], "rest")
    assert rows(named, "c", "name") == [(0, "top"), (1, "next"), (2, "rest")]
    near = nearest_prototype(prof, "c", ["x", "y"], {"p": [9, 1], "q": [0, 0]}, [1, 2])
    assert rows(near, "c", "nearest")[0] == (0, "p") and rows(near, "c", "nearest")[2] == (2, "q")


def test_values(spark):
    df = f6(spark).withColumn("fee", F.lit(2.0)).withColumn("n", F.when(
        F.col("id") == "a", 20).otherwise(3)).withColumn("vol", F.lit(50))
    got = naive_value(df, "fee", "n", "vol").filter("naive_value is not null")
    assert rows(got, "id", "naive_value") == [("a", 5.0)]
    s = {r["variant"]: r for r in sensitivity(df, {
        "all": (None, "value"), "few": (F.col("risk") > .7, "value")}).collect()}
    assert s["few"]["entities"] == 2 and round(s["few"]["vs_first"], 6) == round(6 / 38, 6)


def test_counts_by_pairs(spark):
    df = spark.range(50).withColumn("k", F.col("id") % 4)
    assert rows(reduce_counts(df, "k"))[0][1] > 0


def test_fold_is_stable(spark):
    df = hash_fold(spark.range(1000), ["id"])
    n = df.filter("fold = 'test'").count()
    assert 200 < n < 300 and rows(df) == rows(hash_fold(spark.range(1000), ["id"]))


def test_only_the_declarations_that_are_needed(spark, sf):
    whole = {tuple(r): r for r in feature_table(act(spark, sf), PRIOR, "p_rows", 5).select(
        "site", "player", "lapsed", *PRIOR.tagged("core")).collect()}
    spec = PRIOR.only([*PRIOR.tagged("core"), "p_rows", "lapsed"])
    part = feature_table(act(spark, sf), spec, "p_rows", 5)
    assert {tuple(r) for r in part.select("site", "player", "lapsed", *PRIOR.tagged("core")).collect()} == set(whole)
    assert "p_avg_stack" not in part.columns and "p_max_resources" not in part.columns


def test_conditions_that_differ_in_signs_alone_are_two_figures(spark):
    spec = activity.Spec(figures=[activity.Figure("low", where="x < 2"), activity.Figure("high", where="x > 2")])
    df = spark.createDataFrame([("s", "a", 1, 1), ("s", "a", 1, 3), ("s", "a", 2, 4)],
                               "site string, player string, day int, x int")
    assert rows(entity_figures(df, spec), "low", "high") == [(1, 2)]
