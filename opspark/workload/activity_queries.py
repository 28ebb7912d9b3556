"""Entity features, concurrency, modal values, replay."""

from __future__ import annotations

from pyspark.sql import functions as F

from opspark.operators.activity import entity_figures, feature_table, site_window
from opspark.operators.checks import check_counts as compare_counts
from opspark.operators.checks import check_split as split_check
from opspark.operators.checks import check_windows as compare_windows
from opspark.operators.concurrency import concurrency as busy_of
from opspark.operators.concurrency import distinct_resources
from opspark.operators.modal import modal_value as modal_of
from opspark.operators.replay import LogColumns, replay
from opspark.operators.rollup import pooled_rate as pool
from opspark.session import measured
from opspark.workload.bindings import ACT_SQL, KEYS, LIFETIME, PRIOR, WEEKEND, act
from opspark.workload.quality_queries import MIN_ROWS
from opspark.workload.registry import query

_WEEKEND = ", ".join(str(d) for d in WEEKEND)

USE_SQL = """
busy0 AS (SELECT site, player, bucket, count(DISTINCT resource) AS n FROM {src} GROUP BY ALL),
busy AS (SELECT site, player, max(n) FILTER (n > 0) AS m, avg(n) FILTER (n > 0) AS a,
                count(*) AS active FROM busy0 GROUP BY ALL),
places AS (SELECT site, player, nullif(count(DISTINCT resource), 0) AS d FROM {src} GROUP BY ALL),
flags AS (SELECT site, count(DISTINCT resource) >= 2 AS rec FROM {src} GROUP BY ALL)
"""


@query("WITH " + ACT_SQL + ", " + USE_SQL.format(src="act") + """,
core AS (
  SELECT site, player, count(*) AS rows,
    avg(CAST(voluntary AS INT)) AS voluntary_rate, avg(CAST(raised AS INT)) AS raise_rate,
    avg(CAST(folded AS INT)) AS fold_rate, avg(CAST(showed AS INT)) AS show_rate,
    sum(bets)::BIGINT AS bets, sum(calls)::BIGINT AS calls, avg(invested) AS avg_invested,
    avg(good_stack) AS avg_stack, count(*) FILTER (money_ok) AS money_rows,
    avg(net) FILTER (money_ok) AS avg_net, count(DISTINCT day) AS days_active,
    min(day) AS first_day, max(day) AS last_day, max(site_last_day) AS site_last_day,
    count(*) FILTER (day > cutoff) AS label_rows, count(*) FILTER (day <= cutoff) AS prior_rows,
    count(DISTINCT stake) AS distinct_stakes, max(stake) AS max_stake,
    count(*) FILTER (forced) AS forced_rows_all,
    count(*) FILTER (forced AND voluntary) AS forced_voluntary_all,
    count(*) FILTER (forced AND seats >= 3) AS forced_rows,
    count(*) FILTER (forced AND seats >= 3 AND voluntary) AS forced_voluntary,
    count(*) FILTER (closing AND seats >= 3) AS closing_rows,
    count(*) FILTER (seats >= 3) AS rows_3plus
  FROM act JOIN win USING (site) GROUP BY site, player)
SELECT core.*, CASE WHEN rec THEN m END AS max_resources, CASE WHEN rec THEN a END AS avg_resources,
  active AS active_buckets, CASE WHEN rec THEN d END AS distinct_resources,
  rec AS resources_recorded, voluntary_rate - raise_rate AS voluntary_gap,
  bets / greatest(calls, 1) AS aggression, avg_net * 100 AS net_per_100,
  money_rows / rows AS money_coverage, rows / days_active AS rows_per_day,
  last_day - first_day + 1 AS span_days, site_last_day - last_day AS days_since_last,
  CASE WHEN forced_rows > 0 THEN forced_voluntary / forced_rows END AS forced_voluntary_rate,
  CASE WHEN rows_3plus > 0 THEN closing_rows / rows_3plus END AS closing_share
FROM core JOIN busy USING (site, player) JOIN places USING (site, player) JOIN flags USING (site)
WHERE rows >= 5""")
def player_features(spark, sf_dir):
    """The lifetime table: one row per entity of enough rows."""
    return feature_table(act(spark, sf_dir), LIFETIME, "rows", MIN_ROWS)


PRIOR_SQL = "WITH " + ACT_SQL + """,
before AS (SELECT act.*, cutoff FROM act JOIN win USING (site) WHERE day <= cutoff),
""" + USE_SQL.format(src="before") + f""",
label AS (SELECT site, player, count(*) AS label_rows FROM act JOIN win USING (site)
          WHERE day > cutoff GROUP BY ALL),
core AS (
  SELECT site, player, count(*) AS p_rows, count(DISTINCT day) AS p_days_active,
    min(day) AS p_first_day, max(day) AS p_last_day,
    count(*) FILTER (cutoff - day <= 6) AS p_rows_w1,
    count(*) FILTER (cutoff - day BETWEEN 7 AND 13) AS p_rows_w2,
    count(*) FILTER (cutoff - day <= 2) AS p_rows_last3,
    count(*) FILTER (day IN ({_WEEKEND})) AS p_weekend_rows,
    avg(CAST(voluntary AS INT)) AS p_voluntary_rate, avg(CAST(raised AS INT)) AS p_raise_rate,
    avg(CAST(folded AS INT)) AS p_fold_rate, avg(CAST(showed AS INT)) AS p_show_rate,
    sum(bets)::BIGINT AS p_bets, sum(calls)::BIGINT AS p_calls,
    avg(invested) AS p_avg_invested, avg(seats) AS p_avg_seats,
    count(DISTINCT stake) AS p_distinct_stakes, max(stake) AS p_max_stake,
    min(stake) AS p_min_stake, avg(good_stack) AS p_avg_stack, min(good_stack) AS p_min_stack,
    count(*) FILTER (money_ok) AS p_money_rows, avg(net) FILTER (money_ok) AS p_avg_net,
    count(*) FILTER (forced AND seats >= 3) AS p_forced_rows,
    count(*) FILTER (forced AND seats >= 3 AND voluntary) AS p_forced_voluntary,
    count(*) FILTER (closing AND seats >= 3) AS p_closing_rows,
    count(*) FILTER (seats >= 3) AS p_rows_3plus,
    count(*) FILTER (forced) AS p_forced_rows_all,
    count(*) FILTER (forced AND voluntary) AS p_forced_voluntary_all
  FROM before GROUP BY site, player HAVING count(*) >= 5)
SELECT core.*, coalesce(label_rows, 0) AS label_rows, win.cutoff, win.site_last_day,
  win.site_first_day, CASE WHEN rec THEN m END AS p_max_resources,
  CASE WHEN rec THEN a END AS p_avg_resources, active AS p_active_buckets,
  CASE WHEN rec THEN d END AS p_distinct_resources, rec AS resources_recorded,
  p_avg_stack IS NOT NULL AS stacks_recorded, win.cutoff - p_last_day AS p_recency_days,
  win.cutoff - p_first_day + 1 AS p_tenure_days,
  win.cutoff - win.site_first_day + 1 AS p_prior_span_days,
  p_rows / p_days_active AS p_rows_per_active_day,
  p_days_active / (win.cutoff - p_first_day + 1) AS p_active_day_share,
  p_rows / active AS p_rows_per_bucket, p_rows_w1 / p_rows AS p_late_share,
  p_rows_w1 / greatest(p_rows_w2, 1) AS p_w1_w2_ratio, p_rows_last3 / p_rows AS p_last3_share,
  p_weekend_rows / p_rows AS p_weekend_share, p_voluntary_rate - p_raise_rate AS p_voluntary_gap,
  p_bets / greatest(p_calls, 1) AS p_aggression,
  CASE WHEN p_forced_rows > 0 THEN p_forced_voluntary / p_forced_rows END
    AS p_forced_voluntary_rate,
  CASE WHEN p_rows_3plus > 0 THEN p_closing_rows / p_rows_3plus END AS p_closing_share,
  p_max_stake - p_min_stake AS p_stake_range, p_avg_net * 100 AS p_net_per_100,
  p_money_rows / p_rows AS p_money_coverage, p_money_rows > 0 AS money_recorded,
  CAST(coalesce(label_rows, 0) = 0 AS INT) AS lapsed
FROM core JOIN win USING (site) JOIN busy USING (site, player) JOIN places USING (site, player)
JOIN flags USING (site) LEFT JOIN label USING (site, player)"""


@query(PRIOR_SQL)
def prior_features(spark, sf_dir):
    """The leak-free table: features up to each site's cutoff, label after it."""
    return feature_table(act(spark, sf_dir), PRIOR, "p_rows", MIN_ROWS)


@query("WITH " + ACT_SQL + """,
b AS (SELECT site, player, bucket, count(DISTINCT resource) AS n FROM act
      WHERE resource IS NOT NULL GROUP BY ALL),
c AS (SELECT site, player, max(n) AS max_resources, avg(n) AS avg_resources FROM b GROUP BY ALL),
r AS (SELECT site, player, count(DISTINCT bucket) AS active_buckets,
             nullif(count(DISTINCT resource), 0) AS distinct_resources FROM act GROUP BY ALL)
SELECT * FROM c JOIN r USING (site, player)""")
def concurrency(spark, sf_dir):
    """Peak and mean resources per hour, and resources and active hours in all."""
    a = act(spark, sf_dir)
    return busy_of(a, KEYS, "bucket", "resource").join(
        distinct_resources(a, KEYS, "resource", "bucket"), KEYS)


@query("WITH " + ACT_SQL + """,
c AS (SELECT site, player, stake, count(*) AS n FROM act GROUP BY ALL)
SELECT site, player, max_by(stake, row(n, stake)) AS modal, max(n) AS modal_n,
       sum(n)::BIGINT AS total, count(*) AS n_values
FROM c GROUP BY site, player""")
def modal_value(spark, sf_dir):
    return modal_of(act(spark, sf_dir), KEYS, "stake")


@query("WITH " + ACT_SQL + """,
c AS (SELECT site, player, count(*) AS n, avg(CAST(voluntary AS INT)) AS v,
             avg(CAST(raised AS INT)) AS r FROM act GROUP BY ALL)
SELECT site, sum(n)::BIGINT AS n,
       CAST(floor(sum(v * n) / sum(n) * 1e6 + 0.37) AS BIGINT) AS voluntary_ppm,
       CAST(floor(sum(r * n) / sum(n) * 1e6 + 0.37) AS BIGINT) AS raise_ppm
FROM c GROUP BY site""")
def pooled_rate(spark, sf_dir):
    """Entity rates weighted by rows give back the rate over all rows."""
    from opspark.workload.registry import fixed

    core = entity_figures(act(spark, sf_dir), LIFETIME)
    pooled = pool(core, {"v": "voluntary_rate", "r": "raise_rate"}, "rows", ["site"])
    return pooled.select("site", "n", fixed("v").alias("voluntary_ppm"),
                         fixed("r").alias("raise_ppm"))


LOG_SQL = "WITH " + ACT_SQL + """,
log AS (
  SELECT site || ':' || day AS txn, event_id AS "order", player AS actor,
         CASE WHEN k % 10 = 0 THEN 'board' WHEN k % 10 = 1 THEN 'post' WHEN k % 10 <= 5 THEN 'cbr'
              WHEN k % 10 <= 8 THEN 'cc' ELSE 'f' END AS verb,
         CASE WHEN k % 10 BETWEEN 1 AND 5 THEN event_id * 100000 + cents END AS target
  FROM act)
"""


@query(LOG_SQL + """,
r AS (SELECT *, sum(CAST(verb = 'board' AS INT)) OVER (PARTITION BY txn ORDER BY "order") AS round
      FROM log),
l AS (SELECT *, coalesce(max(CASE WHEN verb IN ('post', 'cbr') THEN target END) OVER (
        PARTITION BY txn, round ORDER BY "order" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
        0) AS level FROM r),
o AS (SELECT *, CASE WHEN verb IN ('post', 'cbr') THEN target WHEN verb = 'cc' THEN level END
        AS reached FROM l),
p AS (SELECT *, coalesce(last_value(reached IGNORE NULLS) OVER (
        PARTITION BY txn, round, actor ORDER BY "order"
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS own,
      min(CASE WHEN reached > 0 THEN actor END) OVER (PARTITION BY txn, round ORDER BY "order"
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lo,
      max(CASE WHEN reached > 0 THEN actor END) OVER (PARTITION BY txn, round ORDER BY "order"
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS hi FROM o)
SELECT txn, "order", CAST(round AS BIGINT) AS round,
       CASE WHEN verb IN ('cbr', 'cc') THEN reached - own WHEN verb = 'post' THEN target
            ELSE 0 END AS amount,
       CASE WHEN verb = 'cbr' THEN CASE WHEN (lo IS NULL OR (lo = actor AND hi = actor))
                 AND target >= level THEN 'bet' ELSE 'raise' END
            WHEN verb = 'cc' THEN CASE WHEN reached > own THEN 'call' ELSE 'check' END
            WHEN verb = 'f' THEN 'fold' ELSE verb END AS kind
FROM p""")
def replay_levels(spark, sf_dir):
    """Every action of every site-day replayed in order."""
    k, a = F.col("k") % 10, act(spark, sf_dir)
    verb = F.when(k == 0, "board").when(k == 1, "post").when(k <= 5, "cbr").when(
        k <= 8, "cc").otherwise("f")
    log = a.select(
        F.concat_ws(":", "site", F.col("day").cast("string")).alias("txn"),
        F.col("event_id").alias("order"), F.col("player").alias("actor"), verb.alias("verb"),
        F.when((k >= 1) & (k <= 5), F.col("event_id") * 100000 + F.col("cents")).alias("target"))
    return replay(log, LogColumns()).select("txn", "order", "round", "amount", "kind")


@query("WITH " + ACT_SQL + """,
p AS (SELECT act.* FROM act JOIN win USING (site) WHERE day <= cutoff),
a AS (SELECT site, player, count(*) AS r, count(DISTINCT stake) AS s FROM p GROUP BY ALL),
b AS (SELECT site, player, sum(n) AS r2, count(*) AS s2 FROM (
        SELECT site, player, stake, count(*) AS n FROM p GROUP BY ALL) GROUP BY ALL),
j AS (SELECT count(*) FILTER (r IS DISTINCT FROM r2) AS rows_off,
             count(*) FILTER (s IS DISTINCT FROM s2) AS stakes_off
      FROM a FULL JOIN b USING (site, player))
SELECT 'p_rows' AS "check", rows_off AS got, 0 AS want, rows_off = 0 AS ok FROM j
UNION ALL SELECT 'p_distinct_stakes', stakes_off, 0, stakes_off = 0 FROM j""")
def check_counts(spark, sf_dir):
    """Prior rows and stakes per entity from two independent builds must agree."""
    a = act(spark, sf_dir)
    core = entity_figures(a, PRIOR).filter("p_rows > 0")
    prior = a.join(measured(site_window(a, "site", "day")), "site").filter("day <= cutoff")
    return compare_counts(core, modal_of(prior, KEYS, "stake"), KEYS,
                          {"p_rows": "total", "p_distinct_stakes": "n_values"})


@query("WITH " + ACT_SQL + """,
a AS (SELECT site, max(last) AS l, max(last) - 7 AS c FROM (
        SELECT site, player, max(day) AS last FROM act GROUP BY ALL) GROUP BY site),
j AS (SELECT count(*) FILTER (l IS DISTINCT FROM site_last_day) AS d,
             count(*) FILTER (c IS DISTINCT FROM cutoff) AS e FROM a FULL JOIN win USING (site))
SELECT 'site_last_day' AS "check", d AS got, 0 AS want, d = 0 AS ok FROM j
UNION ALL SELECT 'cutoff', e, 0, e = 0 FROM j""")
def check_windows(spark, sf_dir):
    """The windows inside a feature table are the windows measured on the rows."""
    a = act(spark, sf_dir)
    inside = entity_figures(a, PRIOR).groupBy("site").agg(
        F.max("site_last_day").alias("site_last_day"), F.max("cutoff").alias("cutoff"))
    return compare_windows(inside, site_window(a, "site", "day"))


@query("WITH " + ACT_SQL + """,
s AS (SELECT count(*) FILTER (day <= cutoff) + count(*) FILTER (day > cutoff) AS got
      FROM act JOIN win USING (site))
SELECT 'prior + label' AS "check", got, (SELECT count(*) FROM events) AS want,
       got = (SELECT count(*) FROM events) AS ok FROM s""")
def check_split(spark, sf_dir):
    a = act(spark, sf_dir)
    total = a.agg(F.count("*").alias("n")).scalar()
    return split_check(entity_figures(a, PRIOR), "p_rows", "label_rows", total)
