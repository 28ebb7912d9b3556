"""Fees: coverage, estimation, attribution, reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from opspark.functions.columns import to_cents, widening_bucket
from opspark.operators.activity import site_window
from opspark.operators.attribute import attribute_fee as attribute
from opspark.operators.attribute import contribution_share as shares
from opspark.operators.checks import check_attribution as attribution_check
from opspark.operators.checks import check_reconcile as reconcile
from opspark.operators.checks import check_zero_sum as zero_sum
from opspark.operators.estimate import (
    apply_cells, fit_cells, level_mix as mix_of_levels, observed_columns, priced_by_site as priced,
    representativeness as compare_observed, share_evidence, validate_cells)
from opspark.operators.joins import value_table
from opspark.operators.replay import derive_fee, net_result, return_excess
from opspark.operators.value import expected_loss, naive_value
from opspark.operators.value import sensitivity as vary
from opspark.functions.keys import hash_percent
from opspark.session import cut
from opspark.workload.bindings import POT_SQL, pot, table
from opspark.workload.quality_queries import BIN_SQL
from opspark.workload.registry import fixed, fixed_sql, query

LEVELS = [["site", "unit_cents", "busy", "bin"], ["site", "busy", "bin"], ["busy", "bin"]]
MIN_CELL = 30
CAP = 0.06

OBS_SQL = "WITH " + POT_SQL + f""",
obs AS (SELECT *, {BIN_SQL} AS bin, coalesce(fee_units <= {CAP} * total_units, FALSE) AS observed
        FROM txns)
"""


def _cells_sql(source: str) -> str:
    return ", ".join(
        f"c{i} AS (SELECT {', '.join(keys)}, avg(fee_units) AS cell{i}, count(*) AS n{i} "
        f"FROM {source} GROUP BY ALL)" for i, keys in enumerate(LEVELS, start=1))


def _applied_sql(target: str) -> str:
    joins = " ".join(f"LEFT JOIN c{i} USING ({', '.join(keys)})"
                     for i, keys in enumerate(LEVELS, start=1))
    return f"""(SELECT *, CASE WHEN n1 >= {MIN_CELL} THEN cell1 WHEN n2 >= {MIN_CELL} THEN cell2
         ELSE coalesce(cell3, 0) END AS est,
       CASE WHEN n1 >= {MIN_CELL} THEN 1 WHEN n2 >= {MIN_CELL} THEN 2 ELSE 3 END AS level
       FROM {target} {joins})"""


PRICED_SQL = OBS_SQL + ", seen AS (SELECT * FROM obs WHERE observed), " + _cells_sql("seen") + f""",
est AS {_applied_sql("obs")},
priced AS (SELECT *, CASE WHEN observed THEN fee_points END AS seen_points,
                  CASE WHEN observed THEN fee_points ELSE est * unit_cents * 100 END AS used_points
           FROM est)
"""


def observed(spark, sf_dir):
    txns, lines = pot(spark, sf_dir)
    txns = observed_columns(txns, "fee_units", "total_units", "unit", CAP)
    # The transaction table is stored once: fit, apply and window all read it.
    return cut(txns.withColumn("bin", widening_bucket("total_units"))), lines


def priced_txns(spark, sf_dir):
    """Every transaction with its fee in points: measured where it can be, else estimated."""
    txns, lines = observed(spark, sf_dir)
    cells = fit_cells(txns.filter("observed"), "fee_observed", LEVELS)
    out = apply_cells(txns, cells, LEVELS, MIN_CELL)
    seen = F.when(F.col("observed"), F.col("fee_points"))
    return out.withColumn("seen_points", seen).withColumn("used_points", F.coalesce(
        seen.cast("double"), F.col("est") * F.col("unit_cents") * 100)), lines


@query(OBS_SQL + f"""
SELECT site, busy, bin, count(*) AS n, {fixed_sql("avg(fee_units)")} AS cell
FROM obs WHERE observed GROUP BY ALL""")
def fee_cells(spark, sf_dir):
    txns, _ = observed(spark, sf_dir)
    _, second, _ = fit_cells(txns.filter("observed"), "fee_observed", LEVELS)
    return second.select("site", "busy", "bin", F.col("n2").alias("n"),
                         fixed("cell2").alias("cell"))


@query(PRICED_SQL + f"""
SELECT txn, level, observed, {fixed_sql("est")} AS est FROM priced""")
def cell_estimate(spark, sf_dir):
    """Finest cell with enough observations, for every transaction; the level is recorded."""
    txns, _ = priced_txns(spark, sf_dir)
    return txns.select("txn", "level", "observed", fixed("est").alias("est"))


@query(OBS_SQL + """,
halves AS (SELECT *, ('0x' || substr(md5(txn || ':42'), 1, 8))::BIGINT % 2 AS half
           FROM obs WHERE observed),
fitted AS (SELECT * FROM halves WHERE half = 0), scoring AS (SELECT * FROM halves WHERE half = 1),
""" + _cells_sql("fitted") + ", e AS " + _applied_sql("scoring") + f"""
SELECT site, count(*) AS n, {fixed_sql("sum(fee_units * unit)", 100)} AS actual,
       {fixed_sql("sum(est * unit)", 100)} AS predicted,
       {fixed_sql("avg(abs(est * unit - fee_units * unit))", 1000)} AS mae,
       {fixed_sql("sum(est * unit) / sum(fee_units * unit)")} AS ratio
FROM e GROUP BY site""")
def estimator_validation(spark, sf_dir):
    """Cells fitted on one hash half, scored on the other."""
    txns, _ = observed(spark, sf_dir)
    v = validate_cells(txns.filter("observed"), ["txn"], "fee_observed", "unit", "site", LEVELS,
                       MIN_CELL)
    return v.select("site", "n", fixed("actual", 100).alias("actual"),
                    fixed("predicted", 100).alias("predicted"), fixed("mae", 1000).alias("mae"),
                    fixed("ratio").alias("ratio"))


@query("WITH " + POT_SQL + f""",
s AS (SELECT site, fee_units / total_units AS share FROM txns
      WHERE fee_units IS NOT NULL AND total_units > 0)
SELECT site, count(*) AS n, avg(CAST(share > {CAP} AS INT)) AS over_cap,
       avg(CAST(share > 0.07 AS INT)) AS at_bound,
       quantile_disc(share, 0.5) AS median, quantile_disc(share, 0.9) AS p90
FROM s GROUP BY site""")
def fee_share(spark, sf_dir):
    txns, _ = pot(spark, sf_dir)
    return share_evidence(txns, "site", "fee_units", "total_units", CAP, 0.07)


@query(OBS_SQL + """
SELECT site, observed, count(*) AS n, avg(total_cents) AS mean_amount,
       avg(CAST(busy AS INT)) AS flag_share, quantile_disc(total_cents, 0.5) AS median_amount
FROM obs GROUP BY 1, 2""")
def representativeness(spark, sf_dir):
    """Do transactions with a measured fee look like those without?"""
    txns, _ = observed(spark, sf_dir)
    return compare_observed(txns, "site", "observed", "total_cents", "busy")


@query(PRICED_SQL + f""",
u AS (SELECT level, count(*) AS n, sum(used_points) AS v FROM priced WHERE NOT observed
      GROUP BY level)
SELECT level, n, {fixed_sql("v / 10000", 1)} AS value, n / (SELECT sum(n) FROM u) AS row_share,
       {fixed_sql("v / (SELECT sum(v) FROM u)")} AS value_share FROM u""")
def level_mix(spark, sf_dir):
    """Rows and money of the estimated transactions by the level that priced them."""
    txns, _ = priced_txns(spark, sf_dir)
    mix = mix_of_levels(txns.filter(~F.col("observed")), "level", "used_points")
    return mix.select("level", "n", fixed(F.col("value") / 10000, 1).alias("value"), "row_share",
                      fixed("value_share").alias("value_share"))


@query(PRICED_SQL + f"""
SELECT site, count(*) AS n, count(seen_points) AS n_observed,
       {fixed_sql("sum(used_points) / 10000", 1)} AS total_used,
       sum(seen_points)::BIGINT AS total_observed, avg(seen_points) AS mean_observed
FROM priced GROUP BY site""")
def priced_by_site(spark, sf_dir):
    txns, _ = priced_txns(spark, sf_dir)
    p = priced(txns, "site", "used_points", "seen_points")
    return p.select("site", "n", "n_observed",
                    fixed(F.col("total_used") / 10000, 1).alias("total_used"), "total_observed",
                    "mean_observed")


@query("WITH " + POT_SQL + """
SELECT s.txn, line, player, cents, n, CASE WHEN whole > 0 THEN cents / whole ELSE 1.0 / n END AS share
FROM seats s JOIN (SELECT txn, sum(cents)::BIGINT AS whole, count(*) AS n FROM seats GROUP BY 1) t
ON s.txn = t.txn""")
def contribution_share(spark, sf_dir):
    _, lines = pot(spark, sf_dir)
    return shares(lines.select("txn", "line", "player", "cents"), "txn", "cents")


FEE_SQL = PRICED_SQL + """,
j AS (SELECT t.site, s.player, s.cents, t.used_points AS used, t.seen_points AS seen, t.day, w.cutoff,
             CASE WHEN t.total_cents > 0 THEN s.cents / t.total_cents ELSE 1.0 / t.n_rows END AS share,
             t.n_rows AS n
      FROM seats s JOIN priced t ON s.txn = t.txn JOIN pwin w ON t.site = w.site),
fees AS (
  SELECT site, player, sum(used * share) FILTER (day <= cutoff) AS p_fee,
    sum(coalesce(seen, 0) * share) FILTER (day <= cutoff) AS p_fee_observed,
    sum(used / n) FILTER (day <= cutoff) AS p_fee_equal,
    count(*) FILTER (day <= cutoff) AS p_rows,
    count(seen) FILTER (day <= cutoff) AS p_rows_observed,
    (sum(cents) FILTER (day <= cutoff))::BIGINT AS p_invested,
    sum(used * share) FILTER (day <= cutoff AND cutoff - day <= 6) AS w1_fee,
    sum(coalesce(seen, 0) * share) FILTER (day <= cutoff AND cutoff - day <= 6) AS w1_fee_observed,
    count(*) FILTER (day <= cutoff AND cutoff - day <= 6) AS w1_rows,
    count(seen) FILTER (day <= cutoff AND cutoff - day <= 6) AS w1_rows_observed,
    sum(used * share) AS all_fee, sum(used / n) AS all_fee_equal, count(*) AS all_rows
  FROM j GROUP BY site, player)
"""
MONEY = ["p_fee", "p_fee_observed", "p_fee_equal", "w1_fee", "w1_fee_observed", "all_fee",
         "all_fee_equal"]
COUNTS = ["p_rows", "p_rows_observed", "p_invested", "w1_rows", "w1_rows_observed", "all_rows"]


def fees_by_player(spark, sf_dir):
    txns, lines = priced_txns(spark, sf_dir)
    return attribute(lines, txns, "txn", ["site", "player"], "cents",
                     {"": "used_points", "_observed": "seen_points"}, "total_cents", "n_rows",
                     "day", site_window(txns, "site", "day"))


@query(FEE_SQL + "SELECT site, player, " + ", ".join(COUNTS) + ", " + ", ".join(
    f"{fixed_sql(m + ' / 100', 1)} AS {m}" for m in MONEY) + " FROM fees")
def attribute_fee(spark, sf_dir):
    """Measured or estimated fees, given to the participants by what they put in."""
    return fees_by_player(spark, sf_dir).select(
        "site", "player", *COUNTS, *[fixed(F.col(m) / 100, 1).alias(m) for m in MONEY])


@query(FEE_SQL + f"""
SELECT 'contributed = equal split' AS "check", {fixed_sql("sum(all_fee) / 10000", 1)} AS got,
       {fixed_sql("sum(all_fee_equal) / 10000", 1)} AS want,
       abs(sum(all_fee) - sum(all_fee_equal)) <= 1e-6 * sum(all_fee_equal) AS ok FROM fees""")
def check_attribution(spark, sf_dir):
    c = attribution_check(fees_by_player(spark, sf_dir))
    return c.select("check", fixed(F.col("got") / 10000, 1).alias("got"),
                    fixed(F.col("want") / 10000, 1).alias("want"), "ok")


RISK_SQL = """(('0x' || substr(md5(site || ':' || player || ':7'), 1, 8))::BIGINT % 100) / 100"""


@query(FEE_SQL + f""",
e AS (SELECT site, player, p_rows, {RISK_SQL} AS risk, w1_fee, p_fee_observed, p_rows_observed,
             w1_rows, CASE WHEN p_rows_observed >= 25 THEN CAST(w1_rows >= 28 AS INT) END AS segment FROM fees
      WHERE p_rows > 0)
SELECT site, player, p_rows, risk, segment, {fixed_sql("coalesce(w1_fee, 0) / 100", 1)} AS weekly,
       {fixed_sql("risk * coalesce(w1_fee, 0) / 100", 1)} AS expected_loss,
       {fixed_sql("CASE WHEN p_rows_observed >= 20 THEN p_fee_observed / p_rows_observed * w1_rows END / 100", 1)}
         AS naive
FROM e""")
def value_at_risk(spark, sf_dir):
    """Features, scores, fees and segments joined; expected loss and the naive estimate."""
    fees = cut(fees_by_player(spark, sf_dir).filter("p_rows > 0"))
    keys = ["site", "player"]
    features = fees.select(*keys, "p_rows")
    scores = fees.select(*keys, (hash_percent(keys, 7) / 100).alias("risk"))
    segments = fees.filter("p_rows_observed >= 25").select(
        *keys, (F.col("w1_rows") >= 28).cast("int").alias("segment"))
    money = fees.select(*keys, "w1_fee", "p_fee_observed", "p_rows_observed", "w1_rows")
    t = expected_loss(value_table(features, scores, money, segments, keys), "risk", "w1_fee")
    t = naive_value(t, "p_fee_observed", "p_rows_observed", "w1_rows")
    weekly = F.coalesce("w1_fee", F.lit(0))
    return t.select(*keys, "p_rows", "risk", "segment", fixed(weekly / 100, 1).alias("weekly"),
                    fixed(F.col("expected_loss") / 100, 1).alias("expected_loss"),
                    fixed(F.col("naive_value") / 100, 1).alias("naive"))


# Name, entities that count, and amount of each variant of the total; the first is the base.
VARIANTS = [("base", "true", "risk * p_fee"), ("probability by rule", "true", "rule * p_fee"),
            ("measured fees only", "true", "risk * p_fee_observed"),
            ("equal split", "true", "risk * p_fee_equal"), ("last week", "true", "risk * w1_fee"),
            ("well measured entities", "p_rows_observed >= 25", "risk * p_fee")]


@query(FEE_SQL + f""",
e AS (SELECT *, {RISK_SQL} AS risk, CASE WHEN w1_rows = 0 THEN 0.9 ELSE 0.3 END AS rule
      FROM fees WHERE p_rows > 0),
b AS (SELECT sum({VARIANTS[0][2]}) AS base FROM e)
""" + " UNION ALL ".join(f"""
SELECT '{name}' AS variant, count(*) FILTER ({keep}) AS entities,
       {fixed_sql(f"sum({amount}) FILTER ({keep}) / 10000", 1)} AS total,
       {fixed_sql(f"sum({amount}) FILTER ({keep}) / max(base)", 1000)} AS vs_base FROM e, b"""
                         for name, keep, amount in VARIANTS))
def fee_sensitivities(spark, sf_dir):
    """The loss by probability source, fee estimator, attribution rule, window and coverage:
    every variant from one table that holds them all."""
    wide = fees_by_player(spark, sf_dir).filter("p_rows > 0").withColumns({
        "risk": hash_percent(["site", "player"], 7) / 100,
        "rule": F.when(F.col("w1_rows") == 0, 0.9).otherwise(0.3)})
    return vary(wide, {n: (F.expr(keep), F.expr(amount)) for n, keep, amount in VARIANTS}).select(
        "variant", "entities", fixed(F.col("total") / 10000, 1).alias("total"),
        fixed("vs_first", 1000).alias("vs_base"))


@query("WITH " + POT_SQL + """,
c AS (SELECT txn, player, sum(cents)::BIGINT AS paid FROM seats GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY txn ORDER BY paid DESC, player) AS rn,
             sum(paid) OVER (PARTITION BY txn) AS s FROM c),
t AS (SELECT txn, max(paid) FILTER (rn = 1) AS a, max(paid) FILTER (rn = 2) AS b FROM r GROUP BY 1)
SELECT txn, player, paid, CASE WHEN rn = 1 THEN coalesce(a - b, 0) ELSE 0 END AS excess,
       paid - CASE WHEN rn = 1 THEN coalesce(a - b, 0) ELSE 0 END AS invested,
       (s - coalesce(a - b, 0))::BIGINT AS total
FROM r JOIN t USING (txn)""")
def top2_excess(spark, sf_dir):
    """What the largest contributor paid above the second goes back."""
    _, lines = pot(spark, sf_dir)
    paid = lines.groupBy("txn", "player").agg(F.sum("cents").alias("paid"))
    return return_excess(paid, "txn", "player", "paid")


PAYOUT_SQL = """CASE WHEN txn % 7 = 0 THEN 0 WHEN txn % 11 = 0 THEN total_cents // 2
  WHEN txn % 13 = 0 THEN total_cents + 1 ELSE total_cents - fee_points // 100 END"""


@query("WITH " + POT_SQL + f""",
p AS (SELECT *, {PAYOUT_SQL} AS payouts FROM txns),
f AS (SELECT *, CASE WHEN payouts > 0 AND total_cents - payouts >= 0
        AND total_cents - payouts <= greatest(total_cents * 0.15, 0.02)
        THEN total_cents - payouts END AS fee FROM p)
SELECT site, count(*) AS n, count(fee) AS accepted, sum(fee)::BIGINT AS fee,
       sum(CASE WHEN fee IS NOT NULL THEN payouts - total_cents END)::BIGINT AS net
FROM f GROUP BY site""")
def derived_fee(spark, sf_dir):
    """The residual as a fee where it can be one; results then sum to minus the fee."""
    txns, _ = pot(spark, sf_dir)
    t, total = F.col("txn"), F.col("total_cents")
    payouts = F.when(t % 7 == 0, F.lit(0)).when(t % 11 == 0, F.floor(total / 2)).when(
        t % 13 == 0, total + 1).otherwise(total - F.floor(F.col("fee_points") / 100))
    fees = derive_fee(txns.withColumn("payouts", payouts), "total_cents", "payouts")
    fees = net_result(fees, "payouts", "total_cents")
    return fees.groupBy("site").agg(
        F.count("*").alias("n"), F.count("fee").alias("accepted"),
        F.sum("fee").cast("bigint").alias("fee"),
        F.sum(F.when(F.col("fee").isNotNull(), F.col("net"))).alias("net"))


@query("WITH " + POT_SQL + """,
per AS (SELECT txn, sum(-cents * tax_pct) AS net FROM seats GROUP BY txn),
j AS (SELECT net, fee_points FROM txns JOIN per USING (txn))
SELECT 'transactions off' AS "check", count(*) FILTER (net <> -fee_points) AS got, 0 AS want,
       count(*) FILTER (net <> -fee_points) = 0 AS ok FROM j
UNION ALL SELECT 'total', sum(net)::DOUBLE, -sum(fee_points)::DOUBLE, sum(net) = -sum(fee_points)
FROM j""")
def check_zero_sum(spark, sf_dir):
    """What participants lost is what the fee took."""
    txns, lines = pot(spark, sf_dir)
    nets = lines.select("txn", (-F.col("cents") * F.col("tax_pct")).alias("net"))
    return zero_sum(nets, txns, "txn", "net", "fee_points")


@query("WITH " + POT_SQL + """,
a AS (SELECT site, stake, sum(total_cents)::BIGINT AS want FROM txns GROUP BY ALL),
b AS (SELECT site, stake, sum(cents)::BIGINT AS got FROM seats JOIN txns USING (txn) GROUP BY ALL)
SELECT site || ':' || stake AS "check", got, want, got = want AS ok FROM a FULL JOIN b
USING (site, stake)""")
def check_reconcile(spark, sf_dir):
    """Totals published per transaction against totals recomputed from participants."""
    txns, lines = pot(spark, sf_dir)
    published = txns.groupBy("site", "stake").agg(F.sum("total_cents").alias("v"))
    again = lines.select("txn", "cents").join(txns.select("txn", "site", "stake"), "txn").groupBy(
        "site", "stake").agg(F.sum("cents").alias("v"))
    return reconcile(published, again, ["site", "stake"], "v")
