"""The operators' input columns, taken from the given tables.

ACT: activity rows from ``events``. POT: transactions from ``orders`` and
``lineitem``. BOOK: one row per ACT entity with a risk, a value and a label.
Each binding has a Spark form and the same thing as SQL text for the oracle.
Money is whole cents, so sums do not depend on the order of the rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opspark.functions.columns import flag_sum, to_cents
from opspark.operators.activity import (
    Derived, Distinct, Figure, Spec, Use, floored, ratio, site_window)
from opspark.session import cut, measured

# Saturdays and Sundays of the month the events cover.
WEEKEND = (6, 7, 13, 14, 20, 21, 27, 28)
KEYS = ["site", "player"]

# Windows as days back from the cutoff.
WINDOWS = {"all": "true", "prior": "age >= 0", "label": "age < 0", "late": "age BETWEEN 0 AND 6",
           "before": "age BETWEEN 7 AND 13", "last3": "age BETWEEN 0 AND 2"}
KNOWN = ("prior", "late", "before", "last3")
RATES = {"voluntary": "voluntary_rate", "raised": "raise_rate", "folded": "fold_rate",
         "showed": "show_rate"}
FINITE_STACK = "CASE WHEN NOT isnan(stack) AND abs(stack) <> double('inf') THEN stack END"
BIG = "seats >= 3"


def _style(prefix: str, window: str, tag: str) -> list[Figure]:
    """Figures that a lifetime table and a prior-window table share."""
    def name(n):
        return prefix + n

    return [
        *[Figure(name(n), "mean", f"int({c})", window=window, tags=(tag,)) for c, n in RATES.items()],
        Figure(name("bets"), "sum", "bets", window=window),
        Figure(name("calls"), "sum", "calls", window=window),
        Figure(name("avg_invested"), "mean", "invested", window=window, tags=(tag,)),
        Figure(name("avg_stack"), "mean", FINITE_STACK, window=window, tags=("rich",)),
        Figure(name("money_rows"), where="money_ok", window=window, tags=("rich",)),
        Figure(name("avg_net"), "mean", "net", "money_ok", window),
        Figure(name("max_stake"), "max", "stake", window=window, tags=(tag,)),
        Figure(name("forced_rows_all"), where="forced", window=window),
        Figure(name("forced_voluntary_all"), where="forced AND voluntary", window=window),
        Figure(name("forced_rows"), where=f"forced AND {BIG}", window=window),
        Figure(name("forced_voluntary"), where=f"forced AND {BIG} AND voluntary", window=window),
        Figure(name("closing_rows"), where=f"closing AND {BIG}", window=window),
        Figure(name("rows_3plus"), where=BIG, window=window),
    ]


def _ratios(prefix: str, rows: str, tag: str) -> list[Derived]:
    def p(text):
        return re.sub(r"@", prefix, text)

    return [
        Derived(p("@voluntary_gap"), p("@voluntary_rate - @raise_rate"), (tag,)),
        Derived(p("@aggression"), floored(p("@bets"), p("@calls")), (tag,)),
        Derived(p("@forced_voluntary_rate"), ratio(p("@forced_voluntary"), p("@forced_rows")), (tag,)),
        Derived(p("@closing_share"), ratio(p("@closing_rows"), p("@rows_3plus")), (tag,)),
        Derived(p("@money_coverage"), ratio(p("@money_rows"), rows), ("rich",)),
        Derived(p("@net_per_100"), p("@avg_net * 100"), ("rich",)),
    ]


LIFETIME = Spec(
    windows=WINDOWS, known=KNOWN, window_columns=["site_last_day"],
    figures=[Figure("rows"), Figure("prior_rows", window="prior"),
             Figure("label_rows", window="label"), Figure("first_day", "min", "day"),
             Figure("last_day", "max", "day"), *_style("", "all", "lifetime")],
    distinct=[Distinct("days_active", "day"), Distinct("distinct_stakes", "stake", tags=("lifetime",))],
    use=Use("max_resources", "avg_resources", "distinct_resources", "active_buckets"),
    derived=[*_ratios("", "rows", "lifetime"), Derived("rows_per_day", "rows / days_active"),
             Derived("span_days", "last_day - first_day + 1"),
             Derived("days_since_last", "site_last_day - last_day")])

PRIOR = Spec(
    windows=WINDOWS, known=KNOWN, window_columns=["cutoff", "site_last_day", "site_first_day"],
    figures=[
        Figure("p_rows", window="prior", tags=("core",)), Figure("label_rows", window="label"),
        Figure("p_first_day", "min", "day", window="prior"),
        Figure("p_last_day", "max", "day", window="prior"),
        Figure("p_rows_w1", window="late", tags=("core",)),
        Figure("p_rows_w2", window="before", tags=("core",)),
        Figure("p_rows_last3", window="last3", tags=("core",)),
        Figure("p_weekend_rows", where=f"day IN {WEEKEND}", window="prior"),
        *_style("p_", "prior", "core"),
        Figure("p_avg_seats", "mean", "seats", window="prior", tags=("core",)),
        Figure("p_min_stake", "min", "stake", window="prior", tags=("core",)),
        Figure("p_min_stack", "min", FINITE_STACK, window="prior", tags=("rich",))],
    distinct=[Distinct("p_days_active", "day", "prior", ("core",)),
              Distinct("p_distinct_stakes", "stake", "prior", ("core",))],
    use=Use("p_max_resources", "p_avg_resources", "p_distinct_resources", "p_active_buckets",
            window="prior", tags=("rich",), active_tags=("core",)),
    derived=[
        *_ratios("p_", "p_rows", "core"),
        Derived("p_recency_days", "cutoff - p_last_day", ("core",)),
        Derived("p_tenure_days", "cutoff - p_first_day + 1", ("core",)),
        Derived("p_prior_span_days", "cutoff - site_first_day + 1", ("core",)),
        Derived("p_rows_per_active_day", ratio("p_rows", "p_days_active"), ("core",)),
        Derived("p_active_day_share", ratio("p_days_active", "p_tenure_days"), ("core",)),
        Derived("p_rows_per_bucket", ratio("p_rows", "p_active_buckets"), ("core",)),
        Derived("p_late_share", ratio("p_rows_w1", "p_rows"), ("core",)),
        Derived("p_w1_w2_ratio", floored("p_rows_w1", "p_rows_w2"), ("core",)),
        Derived("p_last3_share", ratio("p_rows_last3", "p_rows"), ("core",)),
        Derived("p_weekend_share", ratio("p_weekend_rows", "p_rows"), ("core",)),
        Derived("p_stake_range", "p_max_stake - p_min_stake", ("core",)),
        Derived("stacks_recorded", "p_avg_stack IS NOT NULL"),
        Derived("money_recorded", "p_money_rows > 0"),
        Derived("lapsed", "int(label_rows = 0)")])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def act(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    e = table(spark, sf_dir, "events").select(
        "event_id", "ts", F.col("event_type").alias("site"), F.col("user_id").alias("player"),
        F.dayofmonth("ts").alias("day"), F.hour("ts").alias("hour"), k.alias("k"),
        to_cents("value").alias("cents"))
    k, cents, eid = F.col("k"), F.col("cents"), F.col("event_id")
    return e.withColumns({
        "bucket": F.col("day") * 24 + F.col("hour"),
        "resource": F.when(F.col("site") == "error", F.lit(-1)).when(k % 29 != 0, k),
        "stake": k % 4, "seats": 2 + k % 5, "invested": cents,
        "stack": F.when(k == 13, F.lit(float("inf"))).when(k == 14, F.lit(None))
        .when(k == 15, F.lit(float("nan"))).otherwise(cents.cast("double")),
        "money_ok": k < 60, "net": cents - 3000,
        "voluntary": cents >= 2000, "raised": cents >= 6000, "folded": cents < 800,
        "showed": eid % 7 == 0, "bets": k % 3, "calls": k % 4,
        "forced": eid % 6 == 1, "closing": eid % 6 == 5,
    })


ACT_SQL = """
act0 AS (
  SELECT event_id, ts, event_type AS site, user_id AS player,
         CAST(dayofmonth(ts) AS INT) AS day, CAST(hour(ts) AS INT) AS hour,
         CAST(json_extract_string(props, '$.k') AS INT) AS k,
         CAST(round(value * 100) AS BIGINT) AS cents
  FROM events),
act AS (
  SELECT *, day * 24 + hour AS bucket,
         CASE WHEN site = 'error' THEN -1 WHEN k % 29 <> 0 THEN k END AS resource,
         k % 4 AS stake, 2 + k % 5 AS seats, cents AS invested,
         CASE WHEN k = 13 THEN 'inf'::DOUBLE WHEN k = 14 THEN NULL WHEN k = 15 THEN 'nan'::DOUBLE
              ELSE CAST(cents AS DOUBLE) END AS stack,
         CASE WHEN k IN (13, 14, 15) THEN NULL ELSE CAST(cents AS DOUBLE) END AS good_stack,
         k < 60 AS money_ok, cents - 3000 AS net,
         cents >= 2000 AS voluntary, cents >= 6000 AS raised, cents < 800 AS folded,
         event_id % 7 = 0 AS showed, k % 3 AS bets, k % 4 AS calls,
         event_id % 6 = 1 AS forced, event_id % 6 = 5 AS closing
  FROM act0),
win AS (
  SELECT site, min(day) AS site_first_day, max(day) AS site_last_day, max(day) - 7 AS cutoff
  FROM act GROUP BY site)
"""


def pot(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(transactions, participants). Fees are in 1/100 cent: cents times whole percent."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("txn"), F.col("l_suppkey").alias("player"),
        F.col("l_linenumber").alias("line"), to_cents("l_extendedprice").alias("cents"),
        to_cents("l_tax").alias("tax_pct"))
    sums = lines.groupBy("txn").agg(
        F.count("*").alias("n_rows"), F.sum("cents").alias("total_cents"),
        F.sum(F.col("cents") * F.col("tax_pct")).alias("fee_points"))
    geo = (table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", F.col("r_name").alias("site")))
    buyers = (table(spark, sf_dir, "customer").join(
        geo, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "site"))
    unit = F.substring("o_orderpriority", 1, 1).cast("int") * 100000
    txns = (table(spark, sf_dir, "orders")
            .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("o_orderkey").alias("txn"), "site", F.col("o_orderpriority").alias("stake"),
                    F.dayofmonth("o_orderdate").alias("day"), unit.alias("unit_cents"),
                    (F.col("o_orderstatus") == "F").alias("is_final"))
            .join(sums, "txn"))
    txns = txns.withColumns({
        "busy": F.col("n_rows") >= 4,
        "unit": F.col("unit_cents") / 100,
        "total_units": F.col("total_cents") / F.col("unit_cents"),
        "fee_units": F.when(F.col("is_final"),
                            F.col("fee_points") / (F.col("unit_cents") * 100)),
    })
    return txns, lines


POT_SQL = """
seats AS (
  SELECT l_orderkey AS txn, l_suppkey AS player, l_linenumber AS line,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
         CAST(round(l_tax * 100) AS BIGINT) AS tax_pct
  FROM lineitem),
sums AS (
  SELECT txn, count(*) AS n_rows, sum(cents)::BIGINT AS total_cents,
         sum(cents * tax_pct)::BIGINT AS fee_points
  FROM seats GROUP BY txn),
txns AS (
  SELECT o_orderkey AS txn, r_name AS site, o_orderpriority AS stake,
         CAST(dayofmonth(o_orderdate) AS INT) AS day,
         CAST(substr(o_orderpriority, 1, 1) AS INT) * 100000 AS unit_cents,
         o_orderstatus = 'F' AS is_final, n_rows, total_cents, fee_points,
         n_rows >= 4 AS busy,
         CAST(substr(o_orderpriority, 1, 1) AS INT) * 100000 / 100 AS unit,
         total_cents / (CAST(substr(o_orderpriority, 1, 1) AS INT) * 100000) AS total_units,
         CASE WHEN o_orderstatus = 'F' THEN
           fee_points / (CAST(substr(o_orderpriority, 1, 1) AS INT) * 100000 * 100) END AS fee_units
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  JOIN sums ON o_orderkey = txn),
pwin AS (
  SELECT site, max(day) AS site_last_day, max(day) - 7 AS cutoff FROM txns GROUP BY site)
"""


def book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities seen before the cutoff: a risk from a rule, last week's value, the label."""
    a = act(spark, sf_dir)
    day, cutoff = F.col("day"), F.col("cutoff")
    prior = day <= cutoff
    recent = prior & (cutoff - day <= 6)
    g = a.select(*KEYS, "day", "cents", "money_ok").join(
        measured(site_window(a, "site", "day")), "site").groupBy(*KEYS).agg(
        flag_sum(prior).alias("p_rows"), flag_sum(recent).alias("w1_rows"),
        (F.max("cutoff") - F.max(F.when(prior, day))).alias("recency"),
        F.sum(F.when(recent, F.col("cents")).otherwise(0)).alias("weekly"),
        F.sum(F.when(recent & F.col("money_ok"), F.col("cents")).otherwise(0))
        .alias("weekly_measured"),
        (flag_sum(~prior) == 0).cast("int").alias("lapsed"))
    older = F.floor((F.col("p_rows") - F.col("w1_rows")) * 60 / F.col("p_rows"))
    # Gold grain, and every ranking reads it several times: stored once.
    return cut(g.filter(F.col("p_rows") > 0)
            .withColumn("risk_pct", F.least(F.col("recency") * 8 + older, F.lit(100)))
            .withColumn("risk", F.col("risk_pct") / 100)
            .withColumn("loss", F.col("risk_pct") * F.col("weekly")))


BOOK_SQL = "WITH " + ACT_SQL + """,
book0 AS (
  SELECT site, player, count(*) FILTER (day <= cutoff) AS p_rows,
         count(*) FILTER (day <= cutoff AND cutoff - day <= 6) AS w1_rows,
         max(cutoff) - max(day) FILTER (day <= cutoff) AS recency,
         coalesce(sum(cents) FILTER (day <= cutoff AND cutoff - day <= 6), 0)::BIGINT AS weekly,
         coalesce(sum(cents) FILTER (day <= cutoff AND cutoff - day <= 6 AND money_ok), 0)::BIGINT
           AS weekly_measured,
         CAST(count(*) FILTER (day > cutoff) = 0 AS INT) AS lapsed
  FROM act JOIN win USING (site) GROUP BY site, player),
book1 AS (
  SELECT *, CAST(least(recency * 8 + floor((p_rows - w1_rows) * 60 / p_rows), 100) AS BIGINT)
    AS risk_pct
  FROM book0 WHERE p_rows > 0),
book AS (SELECT *, risk_pct / 100 AS risk, risk_pct * weekly AS loss FROM book1)
"""
