"""Group benchmarks, pivots, profiles, cluster reading."""

from __future__ import annotations

from pyspark.sql import functions as F

from opspark.functions.columns import to_cents
from opspark.operators.benchmark import correlations, filter_group_total_sort
from opspark.operators.benchmark import lognormal_fit as fit_lognormal
from opspark.operators.benchmark import mean_median_gap as gap_of
from opspark.operators.benchmark import mean_median_gap_sql as gap_by_sql
from opspark.operators.benchmark import rates
from opspark.operators.benchmark import reduce_counts as count_by
from opspark.operators.benchmark import reduce_mean as mean_by
from opspark.operators.benchmark import salary_benchmark as benchmark_of
from opspark.operators.benchmark import spread as spread_of
from opspark.operators.joins import label_pairs
from opspark.operators.modal import dominant_categories as dominant
from opspark.operators.rollup import outcome_matrix, pivot_counts, segment_profile as profile_of
from opspark.operators.rollup import summary_stats as stats_of
from opspark.operators.segments import agreement, name_by_rules
from opspark.operators.segments import nearest_prototype as nearest
from opspark.workload.bindings import POT_SQL, pot, table
from opspark.workload.registry import fixed, fixed_sql, query


def _sales(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", to_cents("o_totalprice").alias("cents"))
    buyers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    return orders.join(buyers, "o_custkey")


SALES_SQL = """WITH sales AS (
  SELECT c_nationkey, c_mktsegment, CAST(round(o_totalprice * 100) AS BIGINT) AS cents
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

@query(SALES_SQL + """
SELECT c_mktsegment, count(*) AS n, avg(cents) AS mean, quantile_disc(cents, 0.25) AS p25,
       quantile_disc(cents, 0.5) AS median, quantile_disc(cents, 0.75) AS p75,
       quantile_disc(cents, 0.75) - quantile_disc(cents, 0.25) AS iqr
FROM sales GROUP BY 1""")
def salary_benchmark(spark, sf_dir):
    """Count, mean and exact quartiles of a figure per group."""
    return benchmark_of(_sales(spark, sf_dir), "c_mktsegment", "cents")


@query("""
SELECT p_brand, p_type, count(*) AS cohort, avg(CAST(p_size > 10 AS INT)) * 100 AS employed_pct,
       avg(CAST(p_size > 25 AS INT)) * 100 AS placed_pct,
       100 - avg(CAST(p_size > 25 AS INT)) * 100 AS available_pct
FROM part GROUP BY 1, 2""")
def placement_rates(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        "p_brand", "p_type", (F.col("p_size") > 25).alias("placed"),
        (F.col("p_size") > 10).alias("employed"))
    return rates(parts, ["p_brand", "p_type"], "placed", "employed")


GAP_SQL = SALES_SQL + """
SELECT c_nationkey, count(*) AS n, avg(cents) AS mean, quantile_disc(cents, 0.5) AS median,
       avg(cents) - quantile_disc(cents, 0.5) AS gap
FROM sales GROUP BY 1 HAVING count(*) > 40 ORDER BY gap DESC, c_nationkey LIMIT 8"""


@query(GAP_SQL)
def mean_median_gap(spark, sf_dir):
    """The eight groups whose mean lies furthest above their median."""
    return gap_of(_sales(spark, sf_dir), "c_nationkey", "cents", 40, 8)


@query(GAP_SQL)
def mean_median_gap_sql(spark, sf_dir):
    """The same report as SQL text over a view."""
    return gap_by_sql(_sales(spark, sf_dir), "c_nationkey", "cents", 40, 8)


@query(f"""
SELECT 'l_quantity~l_extendedprice' AS pair, {fixed_sql("corr(l_quantity, l_extendedprice)")} AS corr
FROM lineitem
UNION ALL SELECT 'l_discount~l_tax', {fixed_sql("corr(l_discount, l_tax)")} FROM lineitem""")
def correlation(spark, sf_dir):
    c = correlations(table(spark, sf_dir, "lineitem"), [
        ("l_quantity", "l_extendedprice"), ("l_discount", "l_tax")])
    return c.select("pair", fixed("corr").alias("corr"))


@query("SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1")
def reduce_counts(spark, sf_dir):
    return count_by(table(spark, sf_dir, "lineitem"), "l_returnflag")


@query("""
SELECT l_returnflag, count(*) AS n,
       sum(CAST(round(l_extendedprice * 100) AS BIGINT))::BIGINT / count(*) AS mean
FROM lineitem GROUP BY 1""")
def reduce_mean(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", to_cents("l_extendedprice").alias("cents"))
    return mean_by(lines, "l_returnflag", "cents")


@query(SALES_SQL + """
SELECT c_nationkey, count(*) AS n, sum(cents)::BIGINT AS total FROM sales
WHERE c_mktsegment = 'BUILDING' GROUP BY 1""")
def four_verbs(spark, sf_dir):
    """Filter, group, total, sort."""
    return filter_group_total_sort(_sales(spark, sf_dir), F.col("c_mktsegment") == "BUILDING",
                                   "c_nationkey", "cents")


@query(f"""
WITH q AS (SELECT p_brand, quantile_disc(p_retailprice, 0.25) AS a,
                  quantile_disc(p_retailprice, 0.5) AS b, quantile_disc(p_retailprice, 0.75) AS c
           FROM part GROUP BY 1)
SELECT p_brand, {fixed_sql("ln(greatest(b, 1))")} AS mu,
       {fixed_sql("greatest(CASE WHEN c > a AND a > 0 THEN (ln(c) - ln(a)) / 1.35 ELSE 0.10 END, 0.05)")}
         AS sigma
FROM q""")
def lognormal_fit(spark, sf_dir):
    f = fit_lognormal(table(spark, sf_dir, "part"), ["p_brand"], "p_retailprice")
    return f.select("p_brand", fixed("mu").alias("mu"), fixed("sigma").alias("sigma"))


@query(SALES_SQL + """,
m AS (SELECT c_nationkey, quantile_disc(cents, 0.5) AS v FROM sales GROUP BY 1)
SELECT (SELECT min(c_nationkey) FROM m WHERE v = (SELECT max(v) FROM m)) AS best,
       (SELECT min(c_nationkey) FROM m WHERE v = (SELECT min(v) FROM m)) AS worst,
       max(v) AS high, min(v) AS low, max(v) / min(v) AS ratio FROM m""")
def spread(spark, sf_dir):
    """The best and worst group by median, and how far apart they are."""
    return spread_of(benchmark_of(_sales(spark, sf_dir), "c_nationkey", "cents"),
                     "c_nationkey", "median")


@query("""
WITH c AS (SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY n DESC, c_nationkey) AS rk
      FROM c)
SELECT c_mktsegment, string_agg(c_nationkey || ' (' || n || ')', ', ' ORDER BY rk) AS dominant
FROM r WHERE rk <= 3 GROUP BY 1""")
def dominant_categories(spark, sf_dir):
    return dominant(table(spark, sf_dir, "customer"), "c_mktsegment", "c_nationkey", 3)


@query("""
WITH v AS (SELECT 'l_quantity' AS "column", l_quantity AS x FROM lineitem UNION ALL
           SELECT 'l_extendedprice', l_extendedprice FROM lineitem)
SELECT "column", min(x) AS min, quantile_disc(x, 0.25) AS p25, quantile_disc(x, 0.5) AS p50,
       quantile_disc(x, 0.75) AS p75, max(x) AS max FROM v GROUP BY 1""")
def summary_stats(spark, sf_dir):
    return stats_of(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"])


@query("""
SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F",
       count(*) FILTER (o_orderstatus = 'O') AS "O", count(*) FILTER (o_orderstatus = 'P') AS "P",
       count(*) FILTER (o_orderstatus = 'X') AS "X"
FROM orders GROUP BY 1""")
def status_pivot(spark, sf_dir):
    """Counts by fixed column values; a value that never occurs is a column of zeros."""
    return pivot_counts(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus",
                        ["F", "O", "P", "X"])


@query("WITH " + POT_SQL + """
SELECT site, """ + ", ".join(f"""avg(CAST(is_final AS INT)) FILTER (stake = '{p}') AS "{p}\"""" for p in PRIORITIES) + """
FROM txns GROUP BY site""")
def rate_pivot(spark, sf_dir):
    txns, _ = pot(spark, sf_dir)
    return outcome_matrix(txns, "site", "stake", PRIORITIES,
                          F.col("is_final").cast("int"))


def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "label", *[F.element_at("embedding", i + 1).cast("double").alias(x)
                   for i, x in enumerate(AXES)])


AXES = [f"x{i}" for i in range(64)]  # all components of an embedding
VEC_SQL = "WITH v AS (SELECT label, " + ", ".join(
    f"embedding[{i + 1}]::DOUBLE AS {x}" for i, x in enumerate(AXES)) + " FROM embeddings)"


@query(VEC_SQL + f"""
SELECT label, count(*) AS n, {", ".join(f"{fixed_sql(f'avg({x})')} AS avg_{x}" for x in AXES)},
       {fixed_sql("avg(x1)")} AS outcome_rate, avg(CAST(x2 < 0 AS INT)) AS share_negative,
       count(x2) AS n_x2, count(*) / (SELECT count(*) FROM v) AS share
FROM v GROUP BY label""")
def segment_profile(spark, sf_dir):
    p = profile_of(_vectors(spark, sf_dir), "label", AXES, "x1", "x2")
    return p.withColumns({c: fixed(c) for c in [*[f"avg_{x}" for x in AXES], "outcome_rate"]})


# Levels of all axes but the last, and of the last, whose scale is damped.
PROTOTYPES = {"low": (-0.1, -1.0), "middle": (0.0, 0.0), "high": (0.1, 1.0)}


@query(VEC_SQL + ", c AS (SELECT label, " + ", ".join(f"avg({x}) AS {x}" for x in AXES) + """
  FROM v GROUP BY label),
p AS (SELECT * FROM (VALUES """ + ", ".join(
    f"('{n}', {i}, {a}, {b})" for i, (n, (a, b)) in enumerate(PROTOTYPES.items())) + """) t(name, i, pa, pb)),
d AS (SELECT label, name, i, """ + " + ".join(f"power({x} - pa, 2)" for x in AXES[:-1]) + f"""
        + power(({AXES[-1]} - pb) / 12, 2) AS d FROM c, p),
m AS (SELECT label, min_by(name, row(d, i)) AS nearest, min(d) AS d FROM d GROUP BY label)
""" + f"SELECT label, nearest, {fixed_sql('sqrt(d)')} AS distance FROM m")
def nearest_prototype(spark, sf_dir):
    """The closest of three fixed prototypes to each cluster's centre; one axis damped."""
    centres = _vectors(spark, sf_dir).groupBy("label").agg(*[F.avg(x).alias(x) for x in AXES])
    points = {n: [a] * (len(AXES) - 1) + [b] for n, (a, b) in PROTOTYPES.items()}
    n = nearest(centres, "label", AXES, points, [1] * (len(AXES) - 1) + [12])
    return n.select("label", "nearest", fixed("distance").alias("distance"))


@query("""
WITH c AS (SELECT c_nationkey % 5 AS segment, avg(CAST(round(c_acctbal * 100) AS BIGINT)) AS balance,
                  count(*) AS customers, max(c_custkey) AS newest FROM customer GROUP BY 1),
a AS (SELECT max_by(segment, row(balance, -segment)) AS s FROM c),
b AS (SELECT max_by(segment, row(customers, -segment)) AS s FROM c WHERE segment <> (SELECT s FROM a)),
d AS (SELECT max_by(segment, row(newest, -segment)) AS s FROM c
      WHERE segment NOT IN (SELECT s FROM a UNION ALL SELECT s FROM b))
SELECT segment, CASE WHEN segment = (SELECT s FROM a) THEN 'rich'
  WHEN segment = (SELECT s FROM b) THEN 'many' WHEN segment = (SELECT s FROM d) THEN 'new'
  ELSE 'rest' END AS name FROM c""")
def name_segments(spark, sf_dir):
    """Names from measured quantities, in turn, each from the segments still free."""
    profile = table(spark, sf_dir, "customer").groupBy(
        (F.col("c_nationkey") % 5).alias("segment")).agg(
        F.avg(to_cents("c_acctbal")).alias("balance"), F.count("*").alias("customers"),
        F.max("c_custkey").alias("newest"))
    return name_by_rules(profile, "segment", [("rich", "balance"), ("many", "customers"),
                                              ("new", "newest")], "rest").select("segment", "name")


@query("""
WITH p AS (SELECT lang AS a, quality AS b FROM documents JOIN labels USING (doc_id)),
c AS (SELECT b, a, count(*) AS n FROM p GROUP BY ALL),
t AS (SELECT b, max(n) AS top, sum(n) AS al FROM c GROUP BY b)
SELECT sum(top)::BIGINT AS agreeing, sum(al)::BIGINT AS n, count(*) AS labels_b,
       sum(top)::BIGINT / sum(al)::BIGINT AS agreement FROM t""")
def cluster_agreement(spark, sf_dir):
    """Purity of one labeling of the same rows against another."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    marks = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return agreement(label_pairs(docs, marks, ["doc_id"], "lang", "quality"))
