"""Projections, guards, flags, folds and join hygiene."""

from __future__ import annotations

from pyspark.sql import functions as F

from opspark.functions.columns import (
    band, calendar_flag, finite, flag_sum, plausible, time_parts as parts_of_time, to_cents,
    widening_bucket)
from opspark.operators.activity import entity_figures, feature_table, site_window as window_of
from opspark.operators.concurrency import concurrency, distinct_with_sentinel
from opspark.operators.joins import (
    attach_rollup, checked_join as join_checked, drop_colliding, group_mean_baseline as mean_lookup,
    keep_sites, seat_join as join_seats)
from opspark.operators.metrics import skill
from opspark.operators.quality import (
    class_balance as balance, count_non_finite, coverage_by_site as coverage,
    null_indicators as flag_nulls, null_profile as profile_nulls, null_unrecorded,
    one_hot as hot_columns, quality_status, recorded_flags, recorded_share as share_recorded)
from opspark.operators.rollup import child_rollup
from opspark.operators.split import hash_fold as fold_by_hash
from opspark.operators.split import population_report, time_split as split_by_time
from opspark.workload.bindings import (
    ACT_SQL, KEYS, POT_SQL, PRIOR, WEEKEND, act, pot, table)
from opspark.workload.registry import fixed, fixed_sql, query

# Entities have about a dozen events in the given tables, so few rows are asked for.
MIN_ROWS = 5


def _valued_lines(spark, sf_dir):
    cents = to_cents("l_extendedprice")
    value = F.when(F.col("l_linestatus") == "O", F.lit(None)).when(
        F.col("l_discount") >= 0.05, F.lit(0)).otherwise(cents)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), cents.alias("cents"), value.alias("value"))


VALUED_SQL = """
lines AS (
  SELECT l_orderkey, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
         CASE WHEN l_linestatus = 'O' THEN NULL WHEN l_discount >= 0.05 THEN 0
              ELSE CAST(round(l_extendedprice * 100) AS BIGINT) END AS value
  FROM lineitem),
roll AS (
  SELECT l_orderkey, count(*) AS n_rows, avg(cents) AS avg_amount, min(cents) AS min_amount,
         count(value) AS n_values, sum(value)::BIGINT AS sum_values
  FROM lines GROUP BY 1)
"""


@query("WITH " + VALUED_SQL + """
SELECT o_orderkey, n_rows, avg_amount, min_amount, n_values, sum_values
FROM orders LEFT JOIN roll ON o_orderkey = l_orderkey""")
def order_rollup(spark, sf_dir):
    """Every order with its lines rolled up; orders without lines keep nulls."""
    lines = _valued_lines(spark, sf_dir)
    return attach_rollup(table(spark, sf_dir, "orders").select("o_orderkey"),
                         child_rollup(lines, "o_orderkey", "cents", "value"), ["o_orderkey"])


@query("WITH " + VALUED_SQL + """
, s AS (SELECT o_orderpriority, CASE
    WHEN o_orderstatus = 'F' AND o_orderkey % 5 = 0 THEN 'ok' WHEN n_values = 0 THEN 'absent'
    WHEN sum_values = 0 THEN 'all_zero' ELSE 'unreconciled' END AS status
  FROM orders LEFT JOIN roll ON o_orderkey = l_orderkey)
SELECT o_orderpriority, status, count(*) AS n, count(*) FILTER (status = 'ok') AS usable
FROM s GROUP BY 1, 2""")
def money_status(spark, sf_dir):
    fee = F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 5 == 0), 1)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority",
                                                   fee.alias("fee"))
    roll = child_rollup(_valued_lines(spark, sf_dir), "o_orderkey", "cents", "value")
    graded = quality_status(attach_rollup(orders, roll, ["o_orderkey"]), "fee", "n_values",
                            "sum_values")
    return graded.groupBy("o_orderpriority", "status").agg(
        F.count("*").alias("n"), flag_sum(F.col("usable")).alias("usable"))


@query("""
SELECT CAST(hour(ts) AS INT) AS hour, count(*) AS n,
       sum(hour(ts) * 60 + minute(ts))::BIGINT AS minutes,
       CAST(max(dayofmonth(ts) * 1440 + hour(ts) * 60 + minute(ts)) AS INT) AS last_minute_key
FROM events GROUP BY 1""")
def time_parts(spark, sf_dir):
    """Hour, minute of day and minute key from a day and a HH:MM:SS text."""
    e = table(spark, sf_dir, "events").select(
        F.dayofmonth("ts").alias("day"), F.date_format("ts", "HH:mm:ss").alias("time"))
    return e.withColumns(parts_of_time("day", "time")).groupBy("hour").agg(
        F.count("*").alias("n"), F.sum("minute_of_day").alias("minutes"),
        F.max("minute_key").alias("last_minute_key"))


@query("WITH " + ACT_SQL + f"""
SELECT site, count(*) AS n, count(*) FILTER (day IN {tuple(WEEKEND)}) AS weekend,
       avg(CAST(day IN {tuple(WEEKEND)} AS INT)) AS share
FROM act GROUP BY site""")
def weekend_share(spark, sf_dir):
    a = act(spark, sf_dir).withColumn("weekend", calendar_flag("day", WEEKEND))
    return a.groupBy("site").agg(
        F.count("*").alias("n"), flag_sum(F.col("weekend")).alias("is_weekend"),
        F.avg(F.col("weekend").cast("int")).alias("share")).withColumnRenamed(
        "is_weekend", "weekend")


@query("WITH " + ACT_SQL + """
SELECT site, count(*) AS n, count(good_stack) AS n_finite, avg(good_stack) AS avg_stack,
       max(good_stack) AS max_stack
FROM act GROUP BY site""")
def finite_guard(spark, sf_dir):
    a = act(spark, sf_dir).withColumn("stack", finite("stack"))
    return a.groupBy("site").agg(
        F.count("*").alias("n"), F.count("stack").alias("n_finite"),
        F.avg("stack").alias("avg_stack"), F.max("stack").alias("max_stack"))


@query("WITH " + ACT_SQL + """
SELECT 'stack' AS "column", count(*) FILTER (k IN (13, 15)) AS hits FROM act
UNION ALL SELECT 'cents', 0""")
def non_finite_counts(spark, sf_dir):
    a = act(spark, sf_dir).select("stack", F.col("cents").cast("double").alias("cents"))
    return count_non_finite(a, ["stack", "cents"])


@query("WITH " + ACT_SQL + """,
flags AS (SELECT site, count(DISTINCT resource) >= 2 AS recorded FROM act GROUP BY site),
busy AS (SELECT site, player, max(n) AS m FROM (
    SELECT site, player, bucket, count(DISTINCT resource) AS n FROM act
    WHERE resource IS NOT NULL GROUP BY ALL) GROUP BY ALL)
SELECT site, recorded, count(*) AS n,
       (sum(CASE WHEN recorded THEN m END))::BIGINT AS total
FROM busy JOIN flags USING (site) GROUP BY ALL""")
def recorded_flag(spark, sf_dir):
    """A site that writes one filler value has no concurrency: null, and a flag."""
    a = act(spark, sf_dir)
    busy = concurrency(a, KEYS, "bucket", "resource")
    marked = null_unrecorded(busy, recorded_flags(a, "site", "resource"), "site",
                             ["max_resources"])
    return marked.groupBy("site", "recorded").agg(
        F.count("*").alias("n"), F.sum("max_resources").alias("total"))


@query("WITH " + ACT_SQL + """
SELECT site, avg(CAST(good_stack IS NOT NULL AS INT)) AS share FROM act GROUP BY site
HAVING avg(CAST(good_stack IS NOT NULL AS INT)) > 0.5""")
def recorded_share(spark, sf_dir):
    a = act(spark, sf_dir).withColumn("has", finite("stack").isNotNull())
    return share_recorded(a, "site", "has")


@query("WITH " + POT_SQL + """
SELECT site, count(*) AS n, count(fee_units) AS recorded,
       count(*) FILTER (fee_units IS NOT NULL AND fee_units <= 0.06 * total_units) AS plausible
FROM txns GROUP BY site""")
def plausible_fee(spark, sf_dir):
    txns, _ = pot(spark, sf_dir)
    return txns.groupBy("site").agg(
        F.count("*").alias("n"), F.count("fee_units").alias("recorded"),
        flag_sum(plausible("fee_units", "total_units")).alias("plausible"))


BIN_SQL = """CAST(CASE WHEN total_units < 20 THEN floor(total_units) WHEN total_units < 30 THEN 20
  WHEN total_units < 50 THEN 30 WHEN total_units < 100 THEN 50 WHEN total_units < 200 THEN 100
  WHEN total_units < 500 THEN 200 WHEN total_units < 1000 THEN 500 ELSE 1000 END AS INT)"""


@query("WITH " + POT_SQL + f"""
SELECT {BIN_SQL} AS bucket, count(*) AS n, max(total_cents) AS top FROM txns GROUP BY 1""")
def value_bucket(spark, sf_dir):
    txns, _ = pot(spark, sf_dir)
    return txns.groupBy(widening_bucket("total_units").alias("bucket")).agg(
        F.count("*").alias("n"), F.max("total_cents").alias("top"))


@query("""
SELECT c_mktsegment, CASE WHEN c_acctbal > 6000 THEN 'high' WHEN c_acctbal > 2500 THEN 'mid'
       ELSE 'entry' END AS band, count(*) AS n
FROM customer GROUP BY 1, 2""")
def band_counts(spark, sf_dir):
    level = band("c_acctbal", [6000, 2500], ["high", "mid", "entry"])
    return table(spark, sf_dir, "customer").groupBy("c_mktsegment", level.alias("band")).agg(
        F.count("*").alias("n"))


@query("WITH " + ACT_SQL + """,
d AS (SELECT DISTINCT site, player, bucket, coalesce(CAST(resource AS VARCHAR), '∅') AS r FROM act)
SELECT site, count(*) AS n, count(*) FILTER (r <> '∅') AS known, count(DISTINCT bucket) AS buckets
FROM d GROUP BY site""")
def sentinel_counts(spark, sf_dir):
    """Unknown resources are no resource, but the time bucket was active all the same."""
    d = distinct_with_sentinel(act(spark, sf_dir), KEYS, "bucket", "resource")
    counts = d.groupBy("site").agg(
        F.count("*").alias("n"), flag_sum(F.col("resource") != "∅").alias("known"))
    buckets = d.select("site", "bucket").distinct().groupBy("site").agg(
        F.count("*").alias("buckets"))
    return counts.join(buckets, "site")


@query("WITH " + ACT_SQL + """
SELECT site, count(*) AS n, count(*) FILTER (resource IS NULL) AS resource_missing,
       count(*) FILTER (stack IS NULL) AS stack_missing
FROM act GROUP BY site""")
def null_indicators(spark, sf_dir):
    flagged, names = flag_nulls(act(spark, sf_dir), ["cents", "resource", "stack"])
    return flagged.groupBy("site").agg(
        F.count("*").alias("n"), *[F.sum(n).cast("bigint").alias(n) for n in names])


@query("WITH " + ACT_SQL + """
SELECT 'resource' AS "column", avg(CAST(resource IS NULL AS INT)) AS rate FROM act UNION ALL
SELECT 'stack', avg(CAST(stack IS NULL AS INT)) FROM act UNION ALL
SELECT 'cents', avg(CAST(cents IS NULL AS INT)) FROM act UNION ALL
SELECT 'player', avg(CAST(player IS NULL AS INT)) FROM act""")
def null_profile(spark, sf_dir):
    a = act(spark, sf_dir).select("site", "player", "cents", "resource", "stack")
    return profile_nulls(a, exclude=["site"])


@query("""
SELECT c_nationkey, count(*) FILTER (c_mktsegment = 'AUTOMOBILE') AS seg_AUTOMOBILE,
       count(*) FILTER (c_mktsegment = 'FURNITURE') AS seg_FURNITURE,
       count(*) FILTER (c_mktsegment = 'HOUSEHOLD') AS seg_HOUSEHOLD,
       count(*) FILTER (c_mktsegment = 'MACHINERY') AS seg_MACHINERY
FROM customer GROUP BY 1""")
def one_hot(spark, sf_dir):
    hot, names = hot_columns(table(spark, sf_dir, "customer").select(
        "c_nationkey", "c_mktsegment"), "c_mktsegment", "BUILDING", "seg")
    return hot.groupBy("c_nationkey").agg(*[F.sum(n).cast("bigint").alias(n) for n in names])


@query("""
SELECT CASE WHEN ('0x' || substr(md5(c_custkey || ':' || c_mktsegment || ':42'), 1, 8))::BIGINT % 100
            < 25 THEN 'test' ELSE 'train' END AS fold,
       count(*) AS n, sum(c_custkey)::BIGINT AS keys
FROM customer GROUP BY 1""")
def hash_fold(spark, sf_dir):
    return fold_by_hash(table(spark, sf_dir, "customer"), ["c_custkey", "c_mktsegment"]).groupBy(
        "fold").agg(F.count("*").alias("n"), F.sum("c_custkey").alias("keys"))


@query("WITH " + ACT_SQL + """
SELECT site, CASE WHEN day > site_last_day - 4 THEN 'test' ELSE 'train' END AS fold,
       count(*) AS n, min(day) AS first_day, max(day) AS last_day
FROM act JOIN win USING (site) GROUP BY 1, 2""")
def time_split(spark, sf_dir):
    return split_by_time(act(spark, sf_dir), "site", "day").groupBy("site", "fold").agg(
        F.count("*").alias("n"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


@query("WITH " + ACT_SQL + """,
p AS (SELECT site, player, count(*) FILTER (day <= cutoff) AS p,
             count(*) FILTER (day > cutoff) AS l
      FROM act JOIN win USING (site) GROUP BY ALL)
SELECT count(*) AS seen, count(*) FILTER (p >= 10) AS kept,
       count(*) FILTER (p + l >= 10) AS kept_by_lifetime,
       count(*) FILTER (p + l >= 10) - count(*) FILTER (p >= 10) AS leaked
FROM p WHERE p > 0""")
def population_filter(spark, sf_dir):
    """How many entities only a rule that looks into the label window would keep."""
    return population_report(entity_figures(act(spark, sf_dir), PRIOR), "p_rows", "label_rows", 10)


@query("WITH " + ACT_SQL + """,
p AS (SELECT site, player, count(*) FILTER (day <= cutoff) AS p_rows,
        CAST(count(*) FILTER (day > cutoff) = 0 AS INT) AS lapsed,
        max(cutoff) - max(day) FILTER (day <= cutoff) AS recency
      FROM act JOIN win USING (site) GROUP BY ALL)
SELECT site, count(*) AS n, sum(lapsed)::BIGINT AS positives, avg(lapsed) AS prevalence,
       avg(recency) AS mean_p_recency_days, avg(p_rows) AS mean_p_rows
FROM p WHERE p_rows >= 5 GROUP BY site""")
def class_balance(spark, sf_dir):
    g = feature_table(act(spark, sf_dir), PRIOR, "p_rows", MIN_ROWS)
    return balance(g, ["site"], "lapsed", ["p_recency_days", "p_rows"])


@query("WITH " + POT_SQL + f"""
SELECT site, count(*) AS rows, count(fee_units) AS with_figure,
       count(*) FILTER (fee_units <= 0.06 * total_units) AS plausible,
       {fixed_sql("coalesce(sum(fee_units * unit), 0)", 100)} AS money_with_figure,
       {fixed_sql("coalesce(sum(fee_units * unit) FILTER (fee_units <= 0.06 * total_units), 0)", 100)}
         AS money_plausible,
       count(*) FILTER (fee_units <= 0.06 * total_units) / count(*) AS coverage,
       count(*) FILTER (fee_units <= 0.06 * total_units) / count(*) < 0.01 AS excluded
FROM txns GROUP BY site""")
def coverage_by_site(spark, sf_dir):
    txns, _ = pot(spark, sf_dir)
    return coverage(txns, "site", "fee_units", "total_units", "unit").withColumns({
        "money_with_figure": fixed("money_with_figure", 100),
        "money_plausible": fixed("money_plausible", 100)}).drop("money_dropped")


@query("""
WITH dup AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL
             HAVING count(*) > 1)
SELECT (SELECT count(*) FROM dup) AS colliding_keys,
       (SELECT sum(n)::BIGINT FROM dup) AS dropped_rows,
       (SELECT count(*) FROM lineitem) - (SELECT sum(n)::BIGINT FROM dup) AS kept_rows""")
def drop_colliding_keys(spark, sf_dir):
    """Every row of a repeating key goes, and the report says how many that were."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    (clean,), report = drop_colliding(lines, ["l_orderkey", "l_linenumber"])
    return report.withColumn("kept_rows", clean.agg(F.count("*").alias("n")).scalar())


@query("WITH " + POT_SQL + """,
cov AS (SELECT site, avg(CAST(is_final AS INT)) AS coverage FROM txns GROUP BY site),
j AS (SELECT * FROM seats JOIN txns USING (txn) JOIN cov USING (site) WHERE coverage >= 0.01)
SELECT site, stake, count(*) AS n, sum(cents)::BIGINT AS cents, count(DISTINCT player) AS players
FROM j GROUP BY 1, 2""")
def seat_join(spark, sf_dir):
    """Participants with their transaction, at the sites whose coverage reaches the minimum."""
    txns, lines = pot(spark, sf_dir)
    share = txns.groupBy("site").agg(F.avg(F.col("is_final").cast("int")).alias("coverage"))
    joined = join_seats(lines, keep_sites(txns, share), "txn", ["player", "cents"],
                        ["site", "stake"])
    return joined.groupBy("site", "stake").agg(
        F.count("*").alias("n"), F.sum("cents").alias("cents"),
        F.countDistinct("player").alias("players"))


@query("WITH " + ACT_SQL + " SELECT * FROM win")
def site_window(spark, sf_dir):
    return window_of(act(spark, sf_dir), "site", "day")


@query("""
WITH r AS (SELECT l_orderkey FROM lineitem GROUP BY 1),
j AS (SELECT o_orderkey, l_orderkey FROM orders LEFT JOIN r ON o_orderkey = l_orderkey)
SELECT 'rows' AS "check", count(*) AS got, (SELECT count(*) FROM orders) AS want,
       count(*) = (SELECT count(*) FROM orders) AS ok FROM j
UNION ALL
SELECT 'null n_rows', count(*) FILTER (l_orderkey IS NULL), 0,
       count(*) FILTER (l_orderkey IS NULL) = 0 FROM j""")
def checked_join(spark, sf_dir):
    """One roll-up per order: rows must not multiply; orders without lines are reported."""
    roll = child_rollup(_valued_lines(spark, sf_dir), "o_orderkey", "cents", "value")
    _, checks = join_checked(table(spark, sf_dir, "orders").select("o_orderkey"), roll,
                             ["o_orderkey"], ["n_rows"])
    return checks


FOLDED_SQL = """
c AS (SELECT c_custkey, c_nationkey, c_mktsegment, CAST(round(c_acctbal * 100) AS BIGINT) AS cents,
             ('0x' || substr(md5(c_custkey || ':42'), 1, 8))::BIGINT % 100 < 25 AS is_test
      FROM customer),
m AS (SELECT c_nationkey, c_mktsegment, avg(cents) AS m FROM c WHERE NOT is_test GROUP BY ALL),
b AS (SELECT c.*, coalesce(m, (SELECT avg(cents) FROM c WHERE NOT is_test)) AS baseline
      FROM c LEFT JOIN m USING (c_nationkey, c_mktsegment) WHERE is_test)
"""


def _baseline(spark, sf_dir):
    c = fold_by_hash(table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment", to_cents("c_acctbal").alias("cents")),
        ["c_custkey"])
    return mean_lookup(c.filter("fold = 'train'"), c.filter("fold = 'test'"),
                       ["c_nationkey", "c_mktsegment"], "cents")


@query("WITH " + FOLDED_SQL + " SELECT c_custkey, cents, baseline FROM b")
def group_mean_baseline(spark, sf_dir):
    """Training mean per nation and segment; an unseen group gets the grand mean."""
    return _baseline(spark, sf_dir).select("c_custkey", "cents", "baseline")


@query("WITH " + FOLDED_SQL + f"""
SELECT c_nationkey, count(*) AS n,
       {fixed_sql("1 - sum(power(cents - 500000, 2)) / sum(power(cents - baseline, 2))")} AS skill,
       {fixed_sql("sqrt(sum(power(cents - 500000, 2)) / count(*))", 1000)} AS rmse,
       {fixed_sql("avg(abs(cents - baseline))", 1000)} AS baseline_mae
FROM b GROUP BY 1 HAVING count(*) >= 3""")
def skill_score(spark, sf_dir):
    """A constant guess against the group-mean baseline."""
    guess = _baseline(spark, sf_dir).withColumn("guess", F.lit(500000.0))
    s = skill(guess, "cents", "baseline", "guess", ["c_nationkey"], min_n=3)
    return s.select("c_nationkey", "n", fixed("skill").alias("skill"),
                    fixed("rmse", 1000).alias("rmse"),
                    fixed("baseline_mae", 1000).alias("baseline_mae"))
