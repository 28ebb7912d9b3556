"""Models over the prior-window features. Fits differ in the last digits, so rows only.

Models have the library's full sizes; fits that several queries need are shared
within one.
"""

from __future__ import annotations

from functools import partial

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opspark.functions.columns import log_target, invert_log
from opspark.operators.activity import feature_table
from opspark.operators.joins import group_mean_baseline
from opspark.operators.quality import MIN_NULL_RATE, null_indicators, one_hot, recorded_share
from opspark.operators.ranking import rank_auc
from opspark.operators.scan import Measure, running
from opspark.operators.rollup import outcome_matrix
from opspark.operators.split import hash_fold, time_split
from opspark.operators.metrics import confusion, skill
from opspark.plans.calibration import calibrate as calibrate_scores, isotonic
from opspark.plans.clustering import View, compare, prepare, segment_entities, sweep_k
from opspark.plans.models import (
    ablation, as_doubles, category_pipeline, classifier, evaluate_regression, fit_classifier,
    importance as importance_of, importance_by_source, numeric_pipeline, regressor, score,
    scorecard as card_of, side_by_side, target_models, vector_slots)
from opspark.session import cut, packed
from opspark.workload.activity_queries import PRIOR_SQL
from opspark.workload.bindings import ACT_SQL, KEYS, LIFETIME, PRIOR, act, book, table
from opspark.workload.quality_queries import MIN_ROWS
from opspark.workload.registry import fixed, fixed_sql, query

REFERENCE_SITE = "view"
CORE, RICH = PRIOR.tagged("core"), PRIOR.tagged("rich")
HINDSIGHT = LIFETIME.tagged("lifetime")
LEAKS = [*PRIOR.later(), *LIFETIME.later()]


def _features(spark, sf_dir, columns=None):
    """(features as doubles with label and fold, indicators, site dummies); stored for the fits.

    With ``columns`` only these and the label are worked out.
    """
    spec = PRIOR if columns is None else PRIOR.only([*columns, "p_rows", "lapsed"])
    g = feature_table(act(spark, sf_dir), spec, "p_rows", MIN_ROWS)
    g = hash_fold(g.withColumn("label", F.col("lapsed").cast("double")), KEYS)
    g = packed(cut(as_doubles(g, CORE)))
    g, indicators = null_indicators(g, CORE)
    g, dummies = one_hot(g, "site", REFERENCE_SITE)
    return g, indicators, dummies


def _joined(vector, n: int):
    """The first ``n`` slots of a vector as whole numbers of 1/10000, comma-joined."""
    slots = F.slice(vector_to_array(vector), 1, n)
    return F.array_join(F.transform(slots, lambda x: F.floor(x * 1e4 + 0.37).cast("bigint")), ",")


SITES = ["click", "error", "purchase", "signup", "view"]
DUMMIES = [v for v in SITES if v != REFERENCE_SITE]


def _slot(c: str, when: str = "true") -> str:
    """A standardised slot as a whole number of 1/10000; null, and so left out, unless ``when``."""
    return (f"CASE WHEN {when} THEN CAST(floor(CASE WHEN s_{c} > 0 THEN ({c} - a_{c}) / s_{c} ELSE 0 END"
            " * 1e4 + 0.37) AS BIGINT) END")


PREP_SQL = "WITH f AS (WITH " + PRIOR_SQL.replace("WITH ", "", 1) + "), m AS (SELECT " + ", ".join(
    f"quantile_disc({c}::DOUBLE, 0.5) AS {c}" for c in CORE) + " FROM f), i AS (SELECT site, player, " + ", ".join(
    [f"coalesce(f.{c}::DOUBLE, m.{c}) AS {c}, CAST(f.{c} IS NULL AS DOUBLE) AS miss_{c}" for c in CORE]
    + [f"CAST(site = '{v}' AS DOUBLE) AS is_{v}" for v in DUMMIES]) + " FROM f, m), s AS (SELECT " + ", ".join(
    f"avg({c}) AS a_{c}, stddev_samp({c}) AS s_{c}" for c in [
        *CORE, *[f"miss_{c}" for c in CORE], *[f"is_{v}" for v in DUMMIES]]) + """ FROM i)
SELECT site, player, concat_ws(',', """ + ", ".join(
    [_slot(c) for c in CORE] + [_slot(f"miss_{c}", f"a_miss_{c} > {MIN_NULL_RATE}") for c in CORE]
    + [_slot(f"is_{v}", f"a_is_{v} > 0") for v in DUMMIES]) + ") AS features FROM i, s"


@query(PREP_SQL)
def ml_prep(spark, sf_dir):
    """Median fill, indicators, dummies and standardised vectors: every slot of every entity."""
    g, indicators, dummies = _features(spark, sf_dir)
    prep, slots = numeric_pipeline(CORE, indicators, dummies, scale=True, median_error=1e-7)
    return prep.fit(g).transform(g).select(*KEYS, _joined("features", len(slots)).alias("features"))


@query("""
WITH c AS (SELECT c_custkey, c_mktsegment AS seg, CAST(c_nationkey AS VARCHAR) AS nation, c_acctbal
           FROM customer),
t AS (SELECT count(*)::DOUBLE AS n, stddev_samp(c_acctbal) AS s FROM c),
l AS (SELECT 0 AS kind, seg AS v, count(*)::DOUBLE AS k FROM c GROUP BY seg
      UNION ALL SELECT 1, nation, count(*)::DOUBLE FROM c GROUP BY nation),
o AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY k DESC, v) AS i,
             sqrt(k * (n - k) / (n * (n - 1))) AS s FROM l, (SELECT n FROM t)),
x AS (SELECT c_custkey, kind, i, CASE WHEN o.v = CASE kind WHEN 0 THEN seg ELSE nation END
        THEN 1 / s ELSE 0 END AS value FROM c, o
      UNION ALL SELECT c_custkey, 2, 0, c_acctbal / s FROM c, t)
SELECT c_custkey, string_agg(CAST(CAST(floor(value * 1e4 + 0.37) AS BIGINT) AS VARCHAR), ',' ORDER BY kind, i)
  AS features FROM x GROUP BY c_custkey""")
def ml_category_prep(spark, sf_dir):
    """Index, one-hot and scale without centring."""
    c = table(spark, sf_dir, "customer").withColumn("nation", F.col("c_nationkey").cast("string"))
    prep = category_pipeline(["c_mktsegment", "nation"], ["c_acctbal"])
    return prep.fit(c).transform(c).select("c_custkey", _joined("features", 10**6).alias("features"))


FOLD_SQL = "WITH f AS (WITH " + PRIOR_SQL.replace("WITH ", "", 1) + """),
t AS (SELECT * FROM f WHERE ('0x' || substr(md5(site || ':' || player || ':42'), 1, 8))::BIGINT % 100 < 25),
n AS (SELECT count(*) AS n, sum(lapsed)::BIGINT AS p FROM t),
k AS (SELECT * FROM (VALUES ('logistic'), ('tree'), ('forest')) v(kind))
"""


@query(FOLD_SQL + """
SELECT kind || ' ' || c AS "check", CASE c WHEN 'positives' THEN p ELSE n END AS got
FROM k, n, (VALUES ('scored'), ('positives'), ('in range'), ('confusion total')) v(c)
UNION ALL SELECT 'importance total', 1000000
UNION ALL SELECT 'falls of the isotonic map', 0""")
def check_models(spark, sf_dir):
    """What any fit must satisfy: every test row scored once, counts that add up, a monotone map."""
    g, indicators, dummies = _features(spark, sf_dir)
    train, test = g.filter("fold = 'train'"), g.filter("fold = 'test'")
    rows = []
    for kind in ("logistic", "tree", "forest"):
        model, slots = fit_classifier(train, kind, CORE, indicators, dummies, forbidden=LEAKS)
        scored = cut(score(model, test, [*KEYS, "lapsed"]))
        c = confusion(scored.withColumn("hit", (F.col("risk") >= 0.5).cast("int")), "lapsed",
                      "hit").first()
        r = scored.agg(F.count("*"), F.sum("lapsed"), F.count(F.when(
            F.col("risk").between(0, 1), 1))).first()
        rows += [(f"{kind} scored", r[0]), (f"{kind} positives", r[1]), (f"{kind} in range", r[2]),
                 (f"{kind} confusion total", c["tp"] + c["fp"] + c["tn"] + c["fn"])]
    share = importance_by_source(importance_of(model, slots, g)).agg(F.sum("share")).first()[0]
    mapped = isotonic(scored, scored, "lapsed", "risk", "mapped")
    points = mapped.groupBy("risk").agg(F.max("mapped").alias("mapped"))
    falls = running(points, ["risk"], [Measure("before", "max", "mapped", inclusive=False)]).filter(
        F.col("mapped") < F.col("before") - 1e-9).count()
    rows += [("importance total", round(share * 1e6)), ("falls of the isotonic map", falls)]
    return spark.createDataFrame(rows, "check string, got long")


@query()
def lapse_models(spark, sf_dir):
    """Four classifiers beside the recency ranking that needs no training."""
    g, indicators, dummies = _features(spark, sf_dir, CORE)
    train, test = g.filter("fold = 'train'"), g.filter("fold = 'test'")
    out = rank_auc(test, "lapsed", "p_recency_days", KEYS).withColumn("model", F.lit("recency"))

    def one(kind):
        model, _ = fit_classifier(train, kind, CORE, indicators, dummies, forbidden=LEAKS)
        scored = cut(score(model, test, [*KEYS, "lapsed"]))
        return rank_auc(scored, "lapsed", "risk", KEYS).withColumn("model", F.lit(kind))

    for row in side_by_side(g, [partial(one, kind) for kind in ("logistic", "tree", "forest", "gbt")]):
        out = out.unionByName(row)
    return out


@query()
def extended_model(spark, sf_dir):
    """The richer features, at the sites that record them for most entities."""
    g, _, _ = _features(spark, sf_dir)
    kept = recorded_share(g, "site", "resources_recorded").select("site")
    rich = as_doubles(g.join(kept, "site", "left_semi"), RICH)
    model, _ = fit_classifier(rich.filter("fold = 'train'"), "forest",
                              CORE + RICH, forbidden=LEAKS)
    scored = cut(score(model, rich.filter("fold = 'test'"), [*KEYS, "lapsed"]))
    return rank_auc(scored, "lapsed", "risk", KEYS)


@query()
def model_scorecard(spark, sf_dir):
    """Every metric of one model, and its ranking metrics per site in one pass."""
    g, indicators, dummies = _features(spark, sf_dir)
    model, _ = fit_classifier(g.filter("fold = 'train'"), "logistic", CORE, indicators,
                              dummies, forbidden=LEAKS)
    scored = cut(score(model, g.filter("fold = 'test'"), [*KEYS, "lapsed"]))
    return card_of(scored, "lapsed", "risk", KEYS, "site")


@query()
def lapse_scores(spark, sf_dir):
    """The score table: one row per entity with its fold, label and risk."""
    g, indicators, dummies = _features(spark, sf_dir)
    model, _ = fit_classifier(g.filter("fold = 'train'"), "forest", CORE, indicators,
                              dummies, forbidden=LEAKS)
    return score(model, g, [*KEYS, "fold", "label", "p_rows", "p_recency_days", "p_late_share"])


@query()
def value_models(spark, sf_dir):
    """Weekly value by four regressors on the log scale, against the site's mean."""
    b = hash_fold(book(spark, sf_dir), KEYS).withColumn("target", log_target("weekly"))
    cols = ["p_rows", "w1_rows", "recency"]
    prep, _ = numeric_pipeline(cols, scale=True)
    b = cut(as_doubles(b, cols))
    ready = prep.fit(b.filter("fold = 'train'")).transform(b)
    train, test = ready.filter("fold = 'train'"), ready.filter("fold = 'test'")
    span = train.agg(F.min("target").alias("lo"), F.max("target").alias("hi")).first()
    test = group_mean_baseline(train, test, ["site"], "weekly")
    out = None
    for kind in ("linear", "tree", "forest", "gbt"):
        model = regressor(kind, label="target", reg=0.1 if kind == "linear" else 0.0).fit(train)
        pred = model.transform(test).withColumn("pred", invert_log("prediction", *span))
        row = evaluate_regression(pred, "weekly", "pred", "baseline").withColumn(
            "model", F.lit(kind))
        out = row if out is None else out.unionByName(row)
    return out


@query()
def importance(spark, sf_dir):
    """Forest importance, one-hot slots summed back to the column they came from."""
    c = table(spark, sf_dir, "customer").withColumn(
        "nation", F.col("c_nationkey").cast("string"))
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").cast("double").alias("n_orders"))
    c = c.join(orders, "c_custkey", "left").na.fill(0.0, ["n_orders"]).withColumn(
        "label", (F.col("n_orders") > 9).cast("double"))
    c = cut(c)
    prep = category_pipeline(["c_mktsegment", "nation"], ["c_acctbal"]).fit(c)
    ready = prep.transform(c)
    slots = vector_slots(ready, "raw_vector")
    sources = {s: ("c_mktsegment" if s.startswith("c_mktsegment_vec") else
                   "nation" if s.startswith("nation_vec") else s) for s in slots}
    model = PipelineModel(stages=[classifier("forest").fit(ready)])
    return importance_by_source(importance_of(model, slots, ready, sources))


@query()
def leakage_ablation(spark, sf_dir):
    """One model on a floor, on lifetime rates that saw the label week, and on prior features."""
    g, _, _ = _features(spark, sf_dir, CORE)
    life = feature_table(act(spark, sf_dir), LIFETIME.only([*HINDSIGHT, "rows"]), "rows", 1).select(
        *KEYS, *HINDSIGHT)
    both = packed(cut(as_doubles(g.join(life, KEYS, "left"), HINDSIGHT)))
    return ablation(both, "label", KEYS, {
        "floor": ["p_rows", "p_tenure_days"], "lifetime": HINDSIGHT,
        "prior": CORE}, forbidden=LEAKS, leaky=["lifetime"])


@query()
def calibrate(spark, sf_dir):
    """Weighted, unweighted and isotonic probabilities: how far each is off, per fold."""
    g, indicators, dummies = _features(spark, sf_dir, CORE)
    _, report = calibrate_scores(g, "label", KEYS, CORE, indicators, dummies,
                                 forbidden=LEAKS)
    return report


STYLE = ["p_voluntary_rate", "p_raise_rate", "p_fold_rate", "p_show_rate", "p_aggression",
         "p_avg_invested", "p_distinct_stakes", "p_max_stake"]
INTENSITY = ["p_rows", "p_days_active", "p_rows_per_active_day", "p_active_day_share",
             "p_late_share", "p_weekend_share"]
# The second view has nothing to say about the site without recorded stacks.
VIEWS = [
    View("style", STYLE, 4, "p_voluntary_rate",
         [("pushing", "p_aggression"), ("open", "p_voluntary_rate"), ("waiting", "p_fold_rate")],
         "middling"),
    View("intensity", INTENSITY, 4, "p_rows_per_active_day",
         [("heavy", "p_rows"), ("regular", "p_active_day_share"), ("returning", "p_late_share")],
         "occasional", "site <> 'error'")]


def _fitted_segments(spark, sf_dir):
    g, indicators, dummies = _features(spark, sf_dir)
    model, _ = fit_classifier(g.filter("fold = 'train'"), "logistic", CORE, indicators, dummies,
                              forbidden=LEAKS)
    return segment_entities(g, VIEWS, KEYS, score(model, g, KEYS), ["lapsed", "p_rows"])


@query()
def fitted_segments(spark, sf_dir):
    """Each entity's cluster in two fitted views, ranked and named by profile, and its score."""
    return _fitted_segments(spark, sf_dir)[0]


@query()
def fitted_segment_matrix(spark, sf_dir):
    """Share lapsed and mean risk of every fitted segment, all together and at every site."""
    found, _ = _fitted_segments(spark, sf_dir)
    whole = found.groupBy("style", "style_name").agg(
        F.count("*").alias("n"), F.avg("risk").alias("risk"), F.avg("lapsed").alias("all"))
    return whole.join(outcome_matrix(found, "style", "site", SITES, F.col("lapsed")), "style")


SEEN_SQL = "WITH f AS (WITH " + PRIOR_SQL.replace("WITH ", "", 1) + ")"


@query(SEEN_SQL + """
SELECT 'entities' AS "check", count(*) AS got, count(*) AS want FROM f
UNION ALL SELECT 'distinct entities', count(*), count(*) FROM f
UNION ALL SELECT 'scores', count(*), count(*) FROM f
UNION ALL SELECT 'style labels', count(*), count(*) FROM f
UNION ALL SELECT 'intensity labels', count(*) FILTER (site <> 'error'), count(*) FILTER (site <> 'error') FROM f
UNION ALL SELECT v || ' profile entities', count(*) FILTER (v = 'style' OR site <> 'error'),
                 count(*) FILTER (v = 'style' OR site <> 'error')
          FROM f, (VALUES ('style'), ('intensity')) t(v) GROUP BY v
UNION ALL SELECT v || ' shares', 1000000, 1000000 FROM (VALUES ('style'), ('intensity')) t(v)
UNION ALL SELECT v || ' ranks out of order', 0, 0 FROM (VALUES ('style'), ('intensity')) t(v)
UNION ALL SELECT v || ' clusters without a name of their own', 0, 0 FROM (VALUES ('style'), ('intensity')) t(v)
UNION ALL SELECT 'lapsed in the matrix', sum(lapsed)::BIGINT, sum(lapsed)::BIGINT FROM f""")
def check_segments(spark, sf_dir):
    """What any fit of the segments has to satisfy."""
    found, profiles = _fitted_segments(spark, sf_dir)
    n = found.agg(
        F.count("*").alias("entities"), F.count("risk").alias("scores"), F.sum("lapsed").alias("lapsed"),
        F.count("style").alias("style"), F.count("intensity").alias("intensity"),
        F.count(F.when(F.col("site") != "error", 1)).alias("covered")).first()
    rows = [("entities", n.entities, n.entities), ("scores", n.scores, n.entities),
            ("distinct entities", found.select(*KEYS).distinct().count(), n.entities),
            ("style labels", n["style"], n.entities), ("intensity labels", n.intensity, n.covered)]
    for view in VIEWS:
        p = profiles[view.name].orderBy("rank").collect()  # one row per cluster
        means = [r[view.order] for r in p]
        rows += [
            (f"{view.name} profile entities", sum(r.n for r in p),
             n.entities if view.where is None else n.covered),
            (f"{view.name} shares", round(sum(r.share for r in p) * 1e6), 1_000_000),
            (f"{view.name} ranks out of order", sum(a < b for a, b in zip(means, means[1:])), 0),
            (f"{view.name} clusters without a name of their own", len(p) - len({r.name for r in p}), 0)]
    matrix = found.groupBy("style", "site").agg(F.avg("lapsed").alias("rate"), F.count("*").alias("n"))
    lapsed = matrix.agg(F.round(F.sum(F.col("rate") * F.col("n"))).cast("long")).first()[0]
    return spark.createDataFrame([*rows, ("lapsed in the matrix", lapsed, n.lapsed)],
                                 "check string, got long, want long")


TARGETS = {"value": "value", "volume": "volume", "size": "size"}
LAG_FEATURES = ["last_value", "last_volume", "gap", "mean_value", "mean_volume", "days_before"]


def _target_rows(spark, sf_dir):
    """Entity days with three targets, what was known before, and a time split per site."""
    days = act(spark, sf_dir).groupBy(*KEYS, "day").agg(
        F.sum("cents").alias("value"), F.count("*").alias("volume")).withColumn(
        "size", F.col("value") / F.col("volume"))
    # An entity has one row per day at most: a small window.
    w = W.partitionBy(*KEYS).orderBy("day")
    before = w.rowsBetween(W.unboundedPreceding, -1)
    days = days.select(
        "*", F.lag("value").over(w).alias("last_value"), F.lag("volume").over(w).alias("last_volume"),
        (F.col("day") - F.lag("day").over(w)).alias("gap"), F.avg("value").over(before).alias("mean_value"),
        F.avg("volume").over(before).alias("mean_volume"), F.count("*").over(before).alias("days_before"))
    return time_split(days, "site", "day")


TARGET_SQL = "WITH " + ACT_SQL + """,
d AS (SELECT site, player, day, sum(cents)::DOUBLE AS value, count(*)::DOUBLE AS volume,
             sum(cents)::DOUBLE / count(*) AS size FROM act GROUP BY 1, 2, 3),
s AS (SELECT d.*, day > last - 4 AS test FROM d JOIN (SELECT site, max(day) AS last FROM d GROUP BY 1) USING (site)),
l AS (UNPIVOT s ON value, volume, size INTO NAME task VALUE truth),
k AS (SELECT * FROM l WHERE truth >= 0),
m AS (SELECT task, site, avg(truth) AS base, count(*) AS train_rows FROM k WHERE NOT test GROUP BY 1, 2),
g AS (SELECT task, avg(truth) AS grand FROM k WHERE NOT test GROUP BY 1)
"""


@query(TARGET_SQL + f"""
SELECT task, site, coalesce(max(train_rows), 0) AS train_rows, count(*) AS test_rows,
       {fixed_sql("sqrt(avg(power(truth - coalesce(base, grand), 2)))", 1000)} AS baseline_rmse
FROM k JOIN g USING (task) LEFT JOIN m USING (task, site) WHERE test GROUP BY 1, 2""")
def target_baselines(spark, sf_dir):
    """The folds of three fitted targets and the baseline each has to beat, per site."""
    rows = cut(_target_rows(spark, sf_dir))
    pred = target_models(rows, TARGETS, LAG_FEATURES, "site", "linear")
    held = None
    for task, target in TARGETS.items():
        part = rows.filter((F.col("fold") == "train") & (F.col(target) >= 0)).groupBy("site").agg(
            F.count("*").alias("train_rows")).withColumn("task", F.lit(task))
        held = part if held is None else held.unionByName(part)
    return skill(pred, "truth", "baseline", "pred", ["task", "site"]).join(
        held, ["task", "site"], "left").select(
        "task", "site", F.coalesce("train_rows", F.lit(0)).alias("train_rows"),
        F.col("n").alias("test_rows"), fixed("baseline_rmse", 1000).alias("baseline_rmse"))


@query()
def target_skill(spark, sf_dir):
    """Three targets by a forest each: skill per site against the site's mean in train."""
    pred = target_models(cut(_target_rows(spark, sf_dir)), TARGETS, LAG_FEATURES, "site", "forest")
    return skill(pred, "truth", "baseline", "pred", ["task", "site"], 10)


def _vectors(spark, sf_dir):
    return cut(table(spark, sf_dir, "embeddings").select("vec_id", array_to_vector(
        F.col("embedding").cast("array<double>")).alias("features")))


@query()
def kmeans_sweep(spark, sf_dir):
    """Silhouette, cost and shares for k = 2 to 8."""
    return sweep_k(_vectors(spark, sf_dir))


@query()
def kmeans_compare(spark, sf_dir):
    """K-means beside bisecting k-means on the style features of the entities."""
    g, _, _ = _features(spark, sf_dir)
    return compare(cut(prepare(g, STYLE, KEYS)), 4, KEYS)
