"""Rankings, budgets, calibration bins, slices over the entity book."""

from __future__ import annotations

from pyspark.sql import functions as F

from opspark.operators.isotonic import isotonic_pools
from opspark.operators.metrics import class_weights as weights_of
from opspark.operators.metrics import confusion as confuse
from opspark.operators.metrics import task_scorecard, threshold_sweep as sweep
from opspark.operators.ranking import (
    BUDGETS, best_f1 as pick_f1, budget_curve as curve_of, group_budgets, list_overlap as overlap_of,
    order_dimension, rank_auc as auc_of, ranking_comparison as compare_rankings,
    reach_curve as reach_of, recency_baseline as recency_rules, reliability as bins_of,
    top_k as best_of)
from opspark.operators.rollup import slice_table as slices
from opspark.operators.value import headline as headline_of
from opspark.operators.value import sensitivity as vary
from opspark.workload.bindings import BOOK_SQL, KEYS, book
from opspark.workload.registry import fixed, fixed_sql, query

BINNED_SQL = BOOK_SQL + """,
b AS (SELECT *, ntile(10) OVER (ORDER BY risk, site, player) AS bin FROM book),
t AS (SELECT bin, count(*) AS n, min(risk) AS p_low, max(risk) AS p_high, avg(risk) AS mp,
             avg(lapsed) AS observed, sum(power(risk - lapsed, 2)) AS sq FROM b GROUP BY bin)
"""


@query(BINNED_SQL + f"""
SELECT CAST(bin AS INT) AS bin, n, p_low, p_high, {fixed_sql("mp")} AS mean_predicted, observed,
       {fixed_sql("mp - observed")} AS deviation FROM t""")
def reliability(spark, sf_dir):
    """Ten equal-count bins by risk: predicted beside observed."""
    table, _ = bins_of(book(spark, sf_dir), "lapsed", "risk", KEYS)
    return table.select("bin", "n", "p_low", "p_high",
                        fixed("mean_predicted").alias("mean_predicted"), "observed",
                        fixed("deviation").alias("deviation"))


@query(BINNED_SQL + f"""
SELECT {fixed_sql("max(abs(mp - observed))")} AS max_abs_deviation,
       {fixed_sql("sum(n * abs(mp - observed)) / sum(n)")} AS ece,
       {fixed_sql("sum(sq) / sum(n)")} AS brier, sum(n)::BIGINT AS n FROM t""")
def reliability_summary(spark, sf_dir):
    _, s = bins_of(book(spark, sf_dir), "lapsed", "risk", KEYS)
    return s.select(fixed("max_abs_deviation").alias("max_abs_deviation"),
                    fixed("ece").alias("ece"), fixed("brier").alias("brier"), "n")


def _auc_sql(by: str) -> str:
    part = f"PARTITION BY {by} " if by else ""
    cols, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return BOOK_SQL + f""",
r AS (SELECT *, rank() OVER ({part}ORDER BY risk) + (count(*) OVER (PARTITION BY {cols}risk) - 1)
             / 2 AS ar,
             row_number() OVER ({part}ORDER BY risk DESC, site, player) AS rn,
             sum(lapsed) OVER ({part}ORDER BY risk DESC, site, player ROWS UNBOUNDED PRECEDING)
               AS hits
      FROM book)
SELECT {cols}count(*) AS n, sum(lapsed)::BIGINT AS positives,
  {fixed_sql('''CASE WHEN sum(lapsed) > 0 AND sum(lapsed) < count(*) THEN
    (sum(ar) FILTER (lapsed = 1) - sum(lapsed) * (sum(lapsed) + 1) / 2)
    / (sum(lapsed) * (count(*) - sum(lapsed))) END''')} AS roc_auc,
  {fixed_sql("sum(hits / rn) FILTER (lapsed = 1) / nullif(sum(lapsed), 0)")} AS avg_precision
FROM r {group}"""


@query(_auc_sql(""))
def rank_auc(spark, sf_dir):
    a = auc_of(book(spark, sf_dir), "lapsed", "risk", KEYS)
    return a.select("n", "positives", fixed("roc_auc").alias("roc_auc"),
                    fixed("avg_precision").alias("avg_precision"))


@query(_auc_sql("site"))
def rank_auc_by_site(spark, sf_dir):
    """Every site's own ranking metrics in one pass."""
    a = auc_of(book(spark, sf_dir), "lapsed", "risk", KEYS, ["site"])
    return a.select("site", "n", "positives", fixed("roc_auc").alias("roc_auc"),
                    fixed("avg_precision").alias("avg_precision"))


@query(BOOK_SQL + f""",
r AS (SELECT lapsed, row_number() OVER (ORDER BY risk DESC, site, player) AS rn FROM book),
s AS (SELECT count(*) AS n, sum(lapsed) AS pos FROM book),
g AS (SELECT b::DOUBLE AS budget, greatest(CAST(floor(b::DOUBLE * n + 0.5) AS BIGINT), 1) AS k
      FROM s, (SELECT unnest({list(BUDGETS)}) AS b))
SELECT budget, k AS contacted, sum(lapsed) FILTER (rn <= k)::BIGINT AS hits,
       sum(lapsed) FILTER (rn <= k) / k AS precision,
       sum(lapsed) FILTER (rn <= k) / max(pos) AS recall,
       (sum(lapsed) FILTER (rn <= k) / k) / (max(pos) / max(n)) AS lift
FROM r, g, s GROUP BY budget, k""")
def budget_curve(spark, sf_dir):
    return curve_of(book(spark, sf_dir), "lapsed", "risk", KEYS)


@query(BOOK_SQL + """,
c AS (SELECT t / 100 AS threshold, count(*) FILTER (risk >= t / 100 AND lapsed = 1) AS tp,
        count(*) FILTER (risk >= t / 100 AND lapsed = 0) AS fp,
        count(*) FILTER (risk < t / 100 AND lapsed = 0) AS tn,
        count(*) FILTER (risk < t / 100 AND lapsed = 1) AS fn
      FROM book, range(5, 96) g(t) GROUP BY t),
p AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision,
             CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall FROM c)
SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
          ELSE 0 END AS f1
FROM p ORDER BY f1 DESC, threshold LIMIT 1""")
def best_f1(spark, sf_dir):
    """The best of 91 cut-points; the lowest wins a tie."""
    return pick_f1(book(spark, sf_dir), "lapsed", "risk")


ORDERS = {"loss": "loss", "risk": "risk_pct", "value": "weekly"}


@query(BOOK_SQL + """,
p AS (SELECT *, row_number() OVER (ORDER BY loss DESC, site, player) AS p1,
        row_number() OVER (ORDER BY risk_pct DESC, site, player) AS p2,
        row_number() OVER (ORDER BY weekly DESC, site, player) AS p3 FROM book),
k AS (SELECT greatest(CAST(floor(0.1 * count(*) + 0.5) AS BIGINT), 1) AS k, sum(loss) AS total
      FROM book),
l AS (SELECT *, 'loss' AS ranked_by, p1 AS pos FROM p UNION ALL SELECT *, 'risk', p2 FROM p
      UNION ALL SELECT *, 'value', p3 FROM p)
SELECT ranked_by, sum(loss)::BIGINT AS reached, sum(weekly * lapsed)::BIGINT AS realised,
       sum(lapsed)::BIGINT AS hits, count(*) AS contacted, count(*) FILTER (p1 <= k) AS shared,
       sum(loss)::BIGINT / max(total) AS share_of_total, sum(lapsed) / count(*) AS precision,
       count(*) FILTER (p1 <= k) / count(*) AS overlap
FROM l, k WHERE pos <= k GROUP BY ranked_by""")
def ranking_comparison(spark, sf_dir):
    """Whom would each order contact, and what would it reach?"""
    return compare_rankings(book(spark, sf_dir), ORDERS, KEYS, "loss", "weekly", "lapsed")


@query(BOOK_SQL + """,
r AS (SELECT row_number() OVER (ORDER BY loss DESC, site, player) AS rn,
             sum(loss) OVER (ORDER BY loss DESC, site, player ROWS UNBOUNDED PRECEDING) AS reached
      FROM book),
n AS (SELECT count(*) AS n FROM book),
g AS (SELECT i, least(greatest(CAST(floor(i * n / 120 + 0.5) AS BIGINT), 1), n) AS depth, n
      FROM n, range(1, 121) t(i))
SELECT CAST(i AS INT) AS point, depth, depth / n AS share, reached::BIGINT AS reached
FROM g JOIN r ON rn = depth UNION ALL SELECT 0, 0, 0.0, 0""")
def reach_curve(spark, sf_dir):
    return reach_of(book(spark, sf_dir), "loss", KEYS, "loss")


@query(BOOK_SQL + """
SELECT site, sum(loss)::BIGINT AS value,
       CAST(row_number() OVER (ORDER BY sum(loss) DESC, site) - 1 AS INT) AS "index"
FROM book GROUP BY site""")
def dim_order(spark, sf_dir):
    return order_dimension(book(spark, sf_dir), "site", "loss")


@query(BOOK_SQL + """
SELECT site, player, loss FROM book ORDER BY loss DESC, site, player LIMIT 10""")
def top_k(spark, sf_dir):
    return best_of(book(spark, sf_dir).select(*KEYS, "loss"), "loss", KEYS, 10)


@query(BOOK_SQL + """,
a AS (SELECT site, player FROM book ORDER BY loss DESC, site, player LIMIT 50),
b AS (SELECT site, player FROM book ORDER BY weekly DESC, site, player LIMIT 50)
SELECT count(*) AS shared, count(*) / 50 AS share FROM a JOIN b USING (site, player)""")
def list_overlap(spark, sf_dir):
    return overlap_of(book(spark, sf_dir), "loss", "weekly", KEYS, 50)


@query(BOOK_SQL + """
SELECT site, count(*) AS entities, count(*) FILTER (risk >= 0.5) AS flagged,
       sum(lapsed)::BIGINT AS positives, sum(weekly)::BIGINT AS value,
       sum(weekly_measured)::BIGINT AS measured_value, sum(loss)::BIGINT AS expected_loss,
       avg(risk_pct) AS mean_risk_pct, sum(lapsed) / count(*) AS positive_rate,
       sum(loss)::BIGINT / (SELECT sum(loss)::BIGINT FROM book) AS share_of_loss,
       sum(loss)::BIGINT / sum(weekly)::BIGINT AS loss_rate,
       sum(weekly)::BIGINT / count(*) AS value_per_entity,
       sum(weekly_measured)::BIGINT / sum(weekly)::BIGINT AS measured_share
FROM book GROUP BY site""")
def slice_table(spark, sf_dir):
    """Value and expected loss by site."""
    b = book(spark, sf_dir)
    s = slices(b, "site", "risk", "weekly", "loss", "lapsed", "weekly_measured")
    means = b.groupBy("site").agg(F.avg("risk_pct").alias("mean_risk_pct"))
    return s.drop("mean_risk").join(means, "site")


@query(BOOK_SQL + """
SELECT count(*) AS entities, sum(weekly)::BIGINT AS value,
       sum(weekly_measured)::BIGINT AS measured_value, sum(loss)::BIGINT AS expected_loss,
       count(*) FILTER (risk >= 0.5) AS flagged,
       coalesce(sum(weekly) FILTER (risk >= 0.5), 0)::BIGINT AS flagged_value,
       sum(weekly_measured)::BIGINT / sum(weekly)::BIGINT AS measured_share,
       sum(loss)::BIGINT / sum(weekly)::BIGINT AS loss_share
FROM book""")
def headline(spark, sf_dir):
    return headline_of(book(spark, sf_dir), "risk", "weekly", "weekly_measured", "loss")


@query(BOOK_SQL + """,
v AS (SELECT 'chosen' AS variant, count(*) AS entities, sum(loss)::BIGINT AS total FROM book
  UNION ALL SELECT 'measured only', count(*), sum(risk_pct * weekly_measured)::BIGINT FROM book
  UNION ALL SELECT 'flat risk', count(*), sum(50 * weekly)::BIGINT FROM book
  UNION ALL SELECT 'active sites', count(*), sum(loss)::BIGINT FROM book WHERE site <> 'error')
SELECT variant, entities, total, total / (SELECT total FROM v WHERE variant = 'chosen') AS vs_first
FROM v""")
def sensitivity(spark, sf_dir):
    """The headline under other probabilities, figures and subsets."""
    risk, weekly = F.col("risk_pct"), F.col("weekly")
    return vary(book(spark, sf_dir), {
        "chosen": (None, "loss"), "measured only": (None, risk * F.col("weekly_measured")),
        "flat risk": (None, weekly * 50), "active sites": (F.col("site") != "error", "loss")})


CONFUSION_SQL = """SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall,
  CASE WHEN tp > 0 THEN 2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn))
       ELSE 0 END AS f1,
  (tp + tn) / (tp + fp + tn + fn) AS accuracy,
  CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END AS specificity FROM c"""


@query(BOOK_SQL + """,
c AS (SELECT site, count(*) FILTER (risk >= 0.5 AND lapsed = 1) AS tp,
        count(*) FILTER (risk >= 0.5 AND lapsed = 0) AS fp,
        count(*) FILTER (risk < 0.5 AND lapsed = 0) AS tn,
        count(*) FILTER (risk < 0.5 AND lapsed = 1) AS fn FROM book GROUP BY site)
""" + CONFUSION_SQL)
def confusion(spark, sf_dir):
    b = book(spark, sf_dir).withColumn("flag", (F.col("risk") >= 0.5).cast("int"))
    return confuse(b, "lapsed", "flag", ["site"])


@query(BOOK_SQL + """,
g AS (SELECT * FROM (VALUES ('everyone', -1), ('recency >= 1', 1), ('recency >= 2', 2),
        ('recency >= 3', 3), ('recency >= 5', 5)) v(rule, r)),
c AS (SELECT rule, count(*) FILTER (recency >= r AND lapsed = 1) AS tp,
        count(*) FILTER (recency >= r AND lapsed = 0) AS fp,
        count(*) FILTER (recency < r AND lapsed = 0) AS tn,
        count(*) FILTER (recency < r AND lapsed = 1) AS fn FROM book, g GROUP BY rule)
""" + CONFUSION_SQL)
def recency_baseline(spark, sf_dir):
    """What flagging everyone, or everyone quiet for n days, gives without a model."""
    return recency_rules(book(spark, sf_dir), "lapsed", "recency", KEYS)


@query(BOOK_SQL + """,
p AS (SELECT avg(lapsed) AS p FROM book)
SELECT lapsed, count(*) AS n, CASE WHEN lapsed = 1 THEN 1 / (2 * p) ELSE 1 / (2 * (1 - p)) END AS w
FROM book, p GROUP BY lapsed, p""")
def class_weights(spark, sf_dir):
    return weights_of(book(spark, sf_dir), "lapsed").groupBy("lapsed").agg(
        F.count("*").alias("n"), F.max("w").alias("w"))


@query(BOOK_SQL + """,
t AS (SELECT unnest([2, 5, 8, 11]) AS threshold)
SELECT threshold, count(*) AS kept, quantile_disc(weekly, 0.5) AS median,
       avg(CAST(weekly > 20000 AS INT)) AS outlier_share
FROM book, t WHERE p_rows >= threshold GROUP BY threshold""")
def threshold_sweep(spark, sf_dir):
    """Entities kept, their median and outliers, for several minimum row counts."""
    return sweep(book(spark, sf_dir), "p_rows", "weekly", [2, 5, 8, 11], 20000)


@query(BOOK_SQL + """,
r AS (SELECT risk, lapsed, recency FROM book),
s AS (SELECT 'lapse' AS task, avg(lapsed) AS baseline,
             sum(lapsed) FILTER (risk >= 0.2) / count(*) FILTER (risk >= 0.2) AS model FROM r
      UNION ALL
      SELECT 'recency', avg(lapsed),
             sum(lapsed) FILTER (recency >= 2) / count(*) FILTER (recency >= 2) FROM r)
SELECT *, model - baseline AS gain FROM s""")
def scorecard(spark, sf_dir):
    """Each task's score beside its own baseline."""
    b = book(spark, sf_dir)

    def precision(flag):
        return b.agg(F.avg("lapsed").alias("floor"), (
            F.sum(F.when(flag, F.col("lapsed"))) / F.sum(F.when(flag, 1))).alias("score"))

    return task_scorecard({
        "lapse": (precision(F.col("risk") >= 0.2), "score", "floor"),
        "recency": (precision(F.col("recency") >= 2), "score", "floor")})


# The rising fit by its minimax form: the greatest, over the starts, of the least mean to any end.
@query(BOOK_SQL + """,
p AS (SELECT risk_pct AS x, sum(lapsed) AS s, count(*) AS w FROM book GROUP BY 1),
c AS (SELECT *, sum(s) OVER (ORDER BY x) AS cs, sum(w) OVER (ORDER BY x) AS cw FROM p),
m AS (SELECT p.x, l.x AS l, min((r.cs - l.cs + l.s)::DOUBLE / (r.cw - l.cw + l.w)) AS low
      FROM p JOIN c l ON l.x <= p.x JOIN c r ON r.x >= p.x GROUP BY 1, 2),
v AS (SELECT x, max(low) AS v FROM m GROUP BY 1)
SELECT min(x)::DOUBLE AS lo, max(x)::DOUBLE AS hi, sum(s)::BIGINT AS lapsed, sum(w)::BIGINT AS entities
FROM p JOIN v USING (x) GROUP BY v""")
def isotonic_fit(spark, sf_dir):
    """The pools of the rising fit of the label on the risk, pooled in range blocks."""
    pools = isotonic_pools(book(spark, sf_dir), "risk_pct", "lapsed")
    return pools.select("lo", "hi", F.col("total").cast("long").alias("lapsed"),
                        F.col("weight").cast("long").alias("entities"))


@query(BOOK_SQL + f""",
r AS (SELECT site, lapsed, row_number() OVER (PARTITION BY site ORDER BY risk DESC, player) AS rn FROM book),
s AS (SELECT site, count(*) AS n, sum(lapsed) AS pos FROM book GROUP BY site),
g AS (SELECT site, n, pos, b::DOUBLE AS budget, greatest(CAST(floor(b::DOUBLE * n + 0.5) AS BIGINT), 1) AS k
      FROM s, (SELECT unnest({list(BUDGETS)}) AS b))
SELECT site, budget, k AS contacted, sum(lapsed) FILTER (rn <= k)::BIGINT AS hits,
       sum(lapsed) FILTER (rn <= k) / k AS precision,
       CASE WHEN pos > 0 THEN sum(lapsed) FILTER (rn <= k) / pos END AS recall,
       CASE WHEN pos > 0 THEN (sum(lapsed) FILTER (rn <= k) / k) / (pos / n) END AS lift
FROM r JOIN g USING (site) GROUP BY site, budget, k, pos, n""")
def site_budgets(spark, sf_dir):
    """Hits, precision, recall and lift when every site contacts its own share."""
    return group_budgets(book(spark, sf_dir), "lapsed", "risk", KEYS, ["site"])


@query(BOOK_SQL + """,
c AS (SELECT site, t / 100 AS threshold, count(*) FILTER (risk >= t / 100 AND lapsed = 1) AS tp,
        count(*) FILTER (risk >= t / 100 AND lapsed = 0) AS fp,
        count(*) FILTER (risk < t / 100 AND lapsed = 0) AS tn,
        count(*) FILTER (risk < t / 100 AND lapsed = 1) AS fn
      FROM book, range(5, 96) g(t) GROUP BY site, t),
p AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision,
             CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall FROM c),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
          ELSE 0 END AS f1 FROM p)
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY f1 DESC, threshold) AS rn FROM f)
WHERE rn = 1""")
def site_best_f1(spark, sf_dir):
    """The best of 91 cut-points of every site, from one aggregate."""
    return pick_f1(book(spark, sf_dir), "lapsed", "risk", ["site"])
