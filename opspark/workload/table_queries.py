"""Tables put together from several operators, layouts, lookups, samples and the run log."""

from __future__ import annotations

from pyspark.sql import functions as F

from opspark.functions.columns import band, per_unit, small_distinct
from opspark.functions.keys import hash_percent
from opspark.operators.activity import feature_table
from opspark.operators.joins import label_pairs, with_lookup
from opspark.operators.metrics import METRIC_SCHEMA, metrics_long, skill
from opspark.operators.rollup import outcome_matrix
from opspark.operators.split import hash_fold, random_split
from opspark.operators.value import sensitivity
from opspark.session import cut, scratch_path
from opspark.sources.tables import key_layout
from opspark.workload.activity_queries import PRIOR_SQL
from opspark.workload.bindings import BOOK_SQL, KEYS, POT_SQL, PRIOR, act, book, pot, table
from opspark.workload.quality_queries import MIN_ROWS
from opspark.workload.registry import fixed, fixed_sql, query

SITES = ["click", "error", "purchase", "signup", "view"]
WEEKEND_DAYS = (6, 7, 13, 14, 20, 21, 27, 28)


@query("WITH " + POT_SQL + f"""
SELECT txn, site, stake, day, day IN {WEEKEND_DAYS} AS is_weekend, n_rows, total_cents, total_units,
       fee_units, busy,
       CASE WHEN fee_units IS NULL THEN 'absent' WHEN fee_units <= 0.06 * greatest(total_units, 0)
            THEN 'ok' ELSE 'implausible' END AS status
FROM txns""")
def txn_features(spark, sf_dir):
    """One row per transaction: roll-up, money status, calendar flag, size in its own unit."""
    txns, _ = pot(spark, sf_dir)
    good = F.col("fee_units") <= F.lit(0.06) * F.greatest("total_units", F.lit(0))
    return txns.select(
        "txn", "site", "stake", "day", F.col("day").isin(*WEEKEND_DAYS).alias("is_weekend"),
        "n_rows", "total_cents", per_unit("total_cents", "unit_cents").alias("total_units"),
        "fee_units", "busy", F.when(F.col("fee_units").isNull(), "absent").when(good, "ok")
        .otherwise("implausible").alias("status"))


VIEWS_SQL = PRIOR_SQL.replace("WITH ", "", 1)
TWO_SQL = f"""
WITH f AS (WITH {VIEWS_SQL}),
s AS (SELECT site, player, lapsed, p_rows,
        CASE WHEN p_voluntary_rate > 0.7 THEN 'loose' WHEN p_voluntary_rate > 0.5 THEN 'middle'
             ELSE 'tight' END AS style,
        CASE WHEN p_rows_per_active_day > 1.2 THEN 'heavy' WHEN p_rows_per_active_day > 1.05
             THEN 'steady' ELSE 'light' END AS intensity FROM f)
"""


def _segments(spark, sf_dir):
    g = feature_table(act(spark, sf_dir), PRIOR, "p_rows", MIN_ROWS)
    style = g.select(*KEYS, band("p_voluntary_rate", [0.7, 0.5], ["loose", "middle", "tight"])
                     .alias("style"))
    intensity = g.select(*KEYS, band("p_rows_per_active_day", [1.2, 1.05],
                                     ["heavy", "steady", "light"]).alias("intensity"))
    pairs = label_pairs(style, intensity, KEYS, "style", "intensity")
    return cut(g.select(*KEYS, "lapsed", "p_rows").join(
        pairs.withColumnsRenamed({"a": "style", "b": "intensity"}), KEYS))


@query(TWO_SQL + "SELECT * FROM s")
def segment_table(spark, sf_dir):
    """Two label sets per entity, from two views of its features, beside its outcome."""
    return _segments(spark, sf_dir)


@query(TWO_SQL + """
SELECT style, """ + ", ".join("avg(lapsed) FILTER (site = '%s') AS %s" % (s, s) for s in SITES)
       + " FROM s GROUP BY style")
def segment_site_matrix(spark, sf_dir):
    """The outcome of every segment at every site."""
    return outcome_matrix(_segments(spark, sf_dir), "style", "site",
                          SITES, F.col("lapsed"))


@query(BOOK_SQL + """,
v AS (SELECT *, risk_pct * weekly AS l,
             CASE WHEN recency >= 7 THEN 100 ELSE 30 END * weekly AS by_rule,
             risk_pct * weekly_measured AS by_measured,
             risk_pct * p_rows AS by_rows FROM book),
t AS (SELECT sum(l) AS base FROM v)
SELECT 'base' AS variant, count(*) AS entities, sum(l)::BIGINT AS total, sum(l) / max(base) AS vs_first FROM v, t
UNION ALL SELECT 'probability_rule', count(*), sum(by_rule)::BIGINT, sum(by_rule) / max(base) FROM v, t
UNION ALL SELECT 'measured_only', count(*), sum(by_measured)::BIGINT, sum(by_measured) / max(base) FROM v, t
UNION ALL SELECT 'equal_rows', count(*), sum(by_rows)::BIGINT, sum(by_rows) / max(base) FROM v, t
UNION ALL SELECT 'covered_sites', count(*) FILTER (site <> 'error'),
  (sum(l) FILTER (site <> 'error'))::BIGINT, sum(l) FILTER (site <> 'error') / max(base) FROM v, t""")
def sensitivities(spark, sf_dir):
    """The total by probability source, value estimator, attribution and coverage."""
    risk, weekly = F.col("risk_pct"), F.col("weekly")
    rule = F.when(F.col("recency") >= 7, 100).otherwise(30)
    return sensitivity(book(spark, sf_dir), {
        "base": (None, risk * weekly), "probability_rule": (None, rule * weekly),
        "measured_only": (None, risk * F.col("weekly_measured")),
        "equal_rows": (None, risk * F.col("p_rows")),
        "covered_sites": (F.col("site") != "error", risk * weekly)})


TARGETS = {"value": "weekly", "volume": "p_rows", "recency": "recency"}


@query(BOOK_SQL + """,
m AS (SELECT site, avg(weekly) AS weekly, avg(p_rows) AS p_rows, avg(recency) AS recency
      FROM book GROUP BY site),
g AS (SELECT avg(weekly) AS weekly, avg(p_rows) AS p_rows, avg(recency) AS recency FROM book)
""" + " UNION ALL ".join(f"""
SELECT '{t}' AS task, b.site, count(*) AS n, {fixed_sql(
    f"sqrt(avg(power(b.{c} - m.{c}, 2)))", 1000)} AS rmse, {fixed_sql(
    f"sqrt(avg(power(b.{c} - g.{c}, 2)))", 1000)} AS baseline_rmse
FROM book b JOIN m ON b.site = m.site, g GROUP BY b.site HAVING count(*) >= 10"""
                         for t, c in TARGETS.items()))
def skill_by_site(spark, sf_dir):
    """Three targets: the site's mean against the grand mean, per site of enough entities."""
    b, out = book(spark, sf_dir), None
    for task, target in TARGETS.items():
        means = b.groupBy("site").agg(F.avg(target).alias("model"))
        grand = b.agg(F.avg(target)).first()[0]
        row = skill(with_lookup(b, means, "site").withColumn("grand", F.lit(grand)), target,
                    "grand", "model", ["site"], 10).select(
            F.lit(task).alias("task"), "site", "n", fixed("rmse", 1000).alias("rmse"),
            fixed("baseline_rmse", 1000).alias("baseline_rmse"))
        out = row if out is None else out.unionByName(row)
    return out


@query("""
SELECT n_name, r_name, count(*) AS customers, count(DISTINCT c_mktsegment) AS segments
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY 1, 2""")
def named_lookup(spark, sf_dir):
    """Keys replaced by names from two small lookups; broadcast only by measured size."""
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", F.col("n_regionkey").alias("key"))
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("key"), "r_name")
    named = with_lookup(table(spark, sf_dir, "customer"), with_lookup(nation, region, "key"),
                        "c_nationkey")
    return named.groupBy("n_name", "r_name").agg(
        F.count("*").alias("customers"),
        small_distinct("c_mktsegment").cast("bigint").alias("segments"))


@query("SELECT o_custkey, o_orderdate, o_orderkey, o_orderpriority FROM orders")
def written_layout(spark, sf_dir):
    """Rows of a key side by side, newest first, written that way and read back."""
    path = scratch_path(spark, "layout")
    order = [F.desc("o_orderdate"), F.col("o_orderkey")]
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey",
                                                   "o_orderpriority")
    key_layout(orders, ["o_custkey"], order).write.parquet(path)
    return spark.read.schema(orders.schema).parquet(path)


@query("""
SELECT 'parts' AS "check", count(*) AS got, count(*) AS want FROM orders
UNION ALL SELECT 'shared', 0, 0
UNION ALL SELECT 'sample from table', 0, 0
UNION ALL SELECT 'random order', count(*), count(*) FROM orders""")
def random_parts(spark, sf_dir):
    """A random split, a random sample and a random order: what has to hold for any draw."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    n = o.count()
    a, b = random_split(o, 0.3)
    sample = o.sample(0.1, seed=3)
    mixed = o.orderBy(F.rand(5), "o_orderkey")
    rows = [("parts", a.count() + b.count(), n), ("shared", a.join(b, "o_orderkey").count(), 0),
            ("sample from table", sample.join(o, "o_orderkey", "left_anti").count(), 0),
            ("random order", mixed.join(o, "o_orderkey", "left_semi").count(), n)]
    return spark.createDataFrame(rows, "check string, got long, want long")


@query("""
SELECT 'rows' AS metric, o_orderpriority AS slice, count(*)::DOUBLE AS value FROM orders GROUP BY 2
UNION ALL SELECT 'customers', 'all', count(DISTINCT o_custkey)::DOUBLE FROM orders""")
def run_log(spark, sf_dir):
    """Figures of a run written as a long table and read back."""
    o, path = table(spark, sf_dir, "orders"), scratch_path(spark, "run-log")
    per = o.groupBy("o_orderpriority").count().collect()  # one row per priority
    customers = o.select("o_custkey").distinct().count()
    log = metrics_long(spark, [*[("rows", r[0], r[1]) for r in per],
                               ("customers", "all", customers)])
    log.write.mode("append").parquet(path)
    return spark.read.schema(METRIC_SCHEMA).parquet(path)


@query(BOOK_SQL + """
SELECT site, player, CASE WHEN ('0x' || substr(md5(site || ':' || player || ':42'), 1, 8))::BIGINT
         % 100 < 25 THEN 'test' ELSE 'train' END AS fold,
       ('0x' || substr(md5(site || ':' || player || ':9'), 1, 8))::BIGINT % 10 AS part, weekly
FROM book""")
def fixed_folds(spark, sf_dir):
    """The same fold and part for an entity in every run and engine."""
    return hash_fold(book(spark, sf_dir), KEYS).select(
        *KEYS, "fold", hash_percent(KEYS, 9, 10).alias("part"), "weekly")
