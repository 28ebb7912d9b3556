"""Sources, sinks and layouts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from opspark.functions.columns import to_cents
from opspark.operators.modal import latest_per_key as latest_of
from opspark.operators.quality import quarantine
from opspark.operators.quality import quarantine_counts as count_reasons
from opspark.operators.replay import derive_fee, participant_actions, replay, return_excess
from opspark.operators.replay import LogColumns
from opspark.operators.rollup import child_rollup
from opspark.session import cut, scratch_path
from opspark.sources.database import split_index
from opspark.sources.files import (
    append_increment, part_manifest, read_csv, scan_parts, write_csv, write_parquet, write_parts)
from opspark.sources.files import materialise as materialise_step
from opspark.sources.logs import ingest_logs as ingest
from opspark.sources.logs import with_path_meta
from opspark.sources.tables import attach_table as attach
from opspark.sources.tables import prefix_scan as scan_prefix
from opspark.sources.tables import join_buckets, register_table, write_bucketed, write_layout
from opspark.sources.tables import row_key_view as key_view
from opspark.sources.text import ACCESS_LOG_FIELDS, ACCESS_LOG_PATTERN, json_table
from opspark.sources.text import coerce as coerce_columns
from opspark.sources.text import regex_table as split_by_regex
from opspark.workload.bindings import ACT_SQL, POT_SQL, act, pot, table
from opspark.workload.registry import query


# Names of this process in the catalog, so that two runs do not overwrite each other.
_RUN = uuid.uuid4().hex[:8]
CATALOG = {n: f"opspark_{n}_{_RUN}" for n in ("database", "layout", "external", "heads", "lines")}


def _log_text(orders):
    """One TOML document per order: two participants, a raise, a call, an uncalled bet."""
    key = F.col("o_orderkey")
    raised = 2 + key % 5
    half = F.when(key % 2 == 0, F.concat(raised.cast("string"), F.lit(".0"))).otherwise(
        raised.cast("string"))
    payout = F.concat(F.floor(raised * 19 / 10).cast("string"), F.lit("."),
                      (raised * 19 % 10).cast("string"))
    text = F.concat(
        F.lit("[h"), key.cast("string"), F.lit("]\n"),
        F.when(key % 10 != 0, F.concat(F.lit("hand = "), key.cast("string"), F.lit("\n")))
        .otherwise(""),
        F.lit('players = ["c'), F.col("o_custkey").cast("string"), F.lit('", "house"]\n'),
        F.when(key % 10 != 1, "blinds_or_straddles = [0.5, 1]\n").otherwise(
            "blinds_or_straddles = []\n"),
        F.lit("starting_stacks = [inf, 100]\nwinnings = ["), payout, F.lit(", 0]\n"),
        F.lit('table = "t'), (key % 3).cast("string"), F.lit('"\nday = 4\ntime = "12:30:00"\n'),
        F.lit('actions = ["d dh p1 ????", "p1 cbr '), half,
        F.lit('", "p2 cc", "d db AsKsQs", "p2 cc", "p1 cbr 9", "p2 f"]\n'))
    stake = F.substring("o_orderpriority", 1, 1).cast("int") * 0.25
    return orders.select(text.alias("value"), F.col("o_orderstatus").alias("venue"),
                         stake.cast("string").alias("stake"))


@query("""
SELECT o_orderstatus AS site, CAST(substr(o_orderpriority, 1, 1) AS INT) * 0.25::DOUBLE AS stake,
       count(*) FILTER (o_orderkey % 10 > 1) AS n_txns,
       2 * count(*) FILTER (o_orderkey % 10 > 1) AS n_participants,
       (sum(200 * (2 + o_orderkey % 5)) FILTER (o_orderkey % 10 > 1))::BIGINT AS total_cents,
       (sum(10 * (2 + o_orderkey % 5)) FILTER (o_orderkey % 10 > 1))::BIGINT AS fee_cents,
       (sum(900) FILTER (o_orderkey % 10 > 1))::BIGINT AS returned_cents,
       count(*) FILTER (o_orderkey % 10 = 0) AS no_id,
       count(*) FILTER (o_orderkey % 10 = 1) AS no_unit
FROM orders GROUP BY ALL""")
def ingest_logs(spark, sf_dir):
    """Orders written as TOML log files, read back, replayed and balanced."""
    logs = scratch_path(spark, "logs")
    (_log_text(table(spark, sf_dir, "orders")).write.partitionBy("venue", "stake")
     .option("maxRecordsPerFile", 5_000).text(logs))
    t = ingest(spark, logs, stage=scratch_path(spark, "parsed"))
    log = LogColumns(txn="uid")
    done = cut(participant_actions(replay(t["actions"], log), log))
    parts = return_excess(done, "uid", "actor", "contributed").join(
        t["seats"].select("uid", F.col("seat").alias("actor"), "payout"), ["uid", "actor"])
    per = parts.groupBy("uid").agg(
        F.max("total").alias("total"), F.sum("payout").alias("payouts"),
        F.sum("excess").alias("returned"), F.count("*").alias("n"))
    fees = derive_fee(t["txns"].join(per, "uid"), "total", "payouts")
    bad = with_path_meta(t["quarantined"]).groupBy("site", "stake").pivot(
        "problem", ["no_id", "no_unit"]).count().na.fill(0)
    return fees.groupBy("site", "stake").agg(
        F.count("*").alias("n_txns"), F.sum("n").alias("n_participants"),
        F.sum(to_cents("total")).alias("total_cents"), F.sum(to_cents("fee")).alias("fee_cents"),
        F.sum(to_cents("returned")).alias("returned_cents")).join(bad, ["site", "stake"], "left")


@query("""
WITH t AS (SELECT page_id, regexp_extract(url, '//([^/]+)', 1) AS host,
                  regexp_extract(url, '/([0-9]+)[^/]*$', 1) AS num FROM pages)
SELECT page_id,
       CASE WHEN page_id % 2 = 0 THEN host ELSE split_part(host, '-', 1) END AS site,
       CASE WHEN page_id % 2 = 1 THEN host || '-2009' END AS venue_dir,
       TRY_CAST(num AS DOUBLE) AS stake
FROM t""")
def url_meta(spark, sf_dir):
    """Folder metadata in both layouts, from paths made of page addresses."""
    host = F.regexp_extract("url", "//([^/]+)", 1)
    num = F.regexp_extract("url", "/([0-9]+)[^/]*$", 1)
    num = F.when(num == "", "mixed").otherwise(num)
    path = F.when(F.col("page_id") % 2 == 0, F.concat(
        F.lit("/logs/venue="), host, F.lit("/stake="), num, F.lit("/f.toml"))).otherwise(
        F.concat(F.lit("/logs/"), host, F.lit("-2009/"), num, F.lit("/f.toml")))
    return with_path_meta(table(spark, sf_dir, "pages").select(
        "page_id", path.alias("path"))).drop("path")


@query("""
SELECT o_orderkey,
       CASE o_orderkey % 3 WHEN 0 THEN floor(o_totalprice) WHEN 1 THEN o_totalprice END AS amount,
       CAST(CASE o_orderkey % 3 WHEN 0 THEN floor(o_totalprice)
            WHEN 1 THEN floor(o_totalprice) END AS INT) AS whole
FROM orders""")
def coerce(spark, sf_dir):
    """A field that is an integer, a float or not a number, as one type."""
    k, price = F.col("o_orderkey") % 3, F.col("o_totalprice")
    text = F.when(k == 0, F.floor(price).cast("string")).when(
        k == 1, price.cast("decimal(18,2)").cast("string")).otherwise("n/a")
    return coerce_columns(table(spark, sf_dir, "orders").select(
        "o_orderkey", text.alias("amount"), text.alias("whole")),
        {"amount": "double", "whole": "int"})


@query("WITH " + ACT_SQL + """
SELECT CASE WHEN k < 6 THEN 'no_id' ELSE 'no_unit' END AS reason, count(*) AS n
FROM act WHERE k < 6 OR cents < 100 GROUP BY 1""")
def quarantine_counts(spark, sf_dir):
    _, bad = quarantine(act(spark, sf_dir), [("no_id", F.col("k") < 6),
                                            ("no_unit", F.col("cents") < 100)])
    return count_reasons(bad)


@query("""
WITH r AS (SELECT l_orderkey, count(*) AS n, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS c
           FROM lineitem GROUP BY 1)
SELECT n AS n_rows, count(*) AS orders, sum(c)::BIGINT AS cents FROM r GROUP BY n""")
def sink_roundtrip(spark, sf_dir):
    """A roll-up written as a multi-part table and read back."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", to_cents("l_extendedprice").alias("cents"))
    gold = child_rollup(lines, "l_orderkey", "cents", "cents").select(
        "l_orderkey", "n_rows", "sum_values")
    back = write_parquet(gold, scratch_path(spark, "rollup"))
    return back.groupBy("n_rows").agg(
        F.count("*").alias("orders"), F.sum("sum_values").alias("cents"))


@query("WITH " + POT_SQL + """
SELECT site, count(*) AS n, sum(cents)::BIGINT AS cents FROM seats JOIN txns USING (txn)
GROUP BY site""")
def materialise(spark, sf_dir):
    """A costly join stored once; the second use reads what the first one wrote."""
    txns, lines = pot(spark, sf_dir)
    joined = lines.select("txn", "cents").join(txns.select("txn", "site"), "txn")
    path = scratch_path(spark, "seat-join")
    materialise_step(joined, path)
    again = materialise_step(joined, path)
    return again.groupBy("site").agg(F.count("*").alias("n"), F.sum("cents").alias("cents"))


@query("""
SELECT c_mktsegment, count(*) AS n, sum(CAST(round(c_acctbal * 100) AS BIGINT))::BIGINT AS cents
FROM customer GROUP BY 1""")
def csv_roundtrip(spark, sf_dir):
    """A small report as one CSV file with a header, read back with a schema."""
    report = table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(
        F.count("*").alias("n"), F.sum(to_cents("c_acctbal")).alias("cents"))
    path = scratch_path(spark, "report")
    write_csv(report, path, single=True)
    return read_csv(spark, path, "c_mktsegment string, n bigint, cents bigint")


@query("""
SELECT c_nationkey, count(*) AS n, max(c_acctbal) AS top FROM customer GROUP BY 1""")
def managed_table(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    register_table(customers, CATALOG["database"], "customers", scratch_path(spark, "warehouse"))
    return spark.sql("SELECT c_nationkey, count(*) AS n, max(c_acctbal) AS top "
                     f"FROM {CATALOG['database']}.customers GROUP BY c_nationkey")


@query("""
SELECT c_nationkey, count(*) AS n, sum(CAST(round(c_acctbal * 100) AS BIGINT))::BIGINT AS cents
FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY 1""")
def partition_pruned(spark, sf_dir):
    """SQL over a partitioned and bucketed table; only one partition is read."""
    write_layout(table(spark, sf_dir, "customer"), CATALOG["layout"], "c_mktsegment",
                 "c_nationkey", 8, "c_nationkey", scratch_path(spark, "layout"))
    return spark.sql(f"""
        SELECT c_nationkey, count(*) AS n,
               sum(cast(round(c_acctbal * 100) AS bigint)) AS cents
        FROM {CATALOG["layout"]} WHERE c_mktsegment = 'BUILDING' GROUP BY c_nationkey""")


@query("""
SELECT o_orderkey AS key, max(o_custkey) AS customer, count(*) AS n_lines,
       sum(CAST(round(l_extendedprice * 100) AS BIGINT))::BIGINT AS cents
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""")
def bucketed_join(spark, sf_dir):
    """Two tables bucketed alike, joined and totalled bucket by bucket, without a shuffle."""
    heads = write_bucketed(
        table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), "o_custkey"),
        CATALOG["heads"], "key", 8, scratch_path(spark, "heads"))
    lines = write_bucketed(
        table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"),
                                                to_cents("l_extendedprice").alias("cents")),
        CATALOG["lines"], "key", 8, scratch_path(spark, "lines"))
    return join_buckets(lines, heads, "key").groupBy("key").agg(
        F.max("o_custkey").alias("customer"), F.count("*").alias("n_lines"),
        F.sum("cents").alias("cents"))


@query("""
WITH o AS (SELECT count(*) AS n FROM orders), l AS (SELECT count(*) AS n FROM lineitem)
SELECT 'orders in all parts' AS "check", n AS got, n AS want FROM o
UNION ALL SELECT 'lines in all parts', n, n FROM l
UNION ALL SELECT 'lines whose order is in no trial part', 0, 0
UNION ALL SELECT 'orders of the trial, by their keys', 0, 0
UNION ALL SELECT 'lines of the trial, by their keys', 0, 0
UNION ALL SELECT 'trial near a third', 1, 1""")
def shared_parts(spark, sf_dir):
    """The first parts of two tables, cut by one manifest, hold the same keys."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), "l_linenumber")
    manifest, few = part_manifest(orders, "key", 9), 3
    places = {}
    for name, df in (("orders", orders), ("lines", lines)):
        places[name] = scratch_path(spark, name)
        write_parts(df, "key", manifest, places[name])
    whole = {n: scan_parts(spark, p, (orders if n == "orders" else lines).schema) for n, p in places.items()}
    some = {n: scan_parts(spark, p, whole[n].schema, few) for n, p in places.items()}
    end = manifest.filter(F.col("part") == few).first().lo
    n, total = some["orders"].count(), orders.count()
    rows = [("orders in all parts", whole["orders"].count(), total),
            ("lines in all parts", whole["lines"].count(), lines.count()),
            ("lines whose order is in no trial part",
             some["lines"].join(some["orders"], "key", "left_anti").count(), 0),
            ("orders of the trial, by their keys", n - orders.filter(F.col("key") < end).count(), 0),
            ("lines of the trial, by their keys",
             some["lines"].count() - lines.filter(F.col("key") < end).count(), 0),
            ("trial near a third", int(abs(n / total - few / 9) < 0.02), 1)]
    return spark.createDataFrame(rows, "check string, got long, want long")


@query("""
SELECT o_orderstatus, count(*) AS n, max(o_orderkey) AS last_key FROM orders GROUP BY 1""")
def attach_table(spark, sf_dir):
    """Partition folders already on disk, found by an external table."""
    path = scratch_path(spark, "external")
    write_parquet(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"),
                  path, by=["o_orderstatus"])
    t = attach(spark, CATALOG["external"], path,
               "o_orderkey bigint, o_custkey bigint, o_orderstatus string", ["o_orderstatus"])
    return t.groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.max("o_orderkey").alias("last_key"))


@query("""
WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders),
r AS (SELECT o_orderkey, least((o_orderkey - lo) // ((hi - lo + 1) // 7), 6) AS range_no
      FROM orders, b)
SELECT CAST(range_no AS INT) AS range_no, count(*) AS n, min(o_orderkey) AS low,
       max(o_orderkey) AS high
FROM r GROUP BY 1""")
def split_read(spark, sf_dir):
    """Which of seven parallel read ranges every order falls in; the last takes the rest."""
    orders = table(spark, sf_dir, "orders")
    b = orders.agg(F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"))
    which = split_index("o_orderkey", b.select("lo").scalar(), b.select("hi").scalar(), 7)
    return orders.groupBy(which.alias("range_no")).agg(
        F.count("*").alias("n"), F.min("o_orderkey").alias("low"),
        F.max("o_orderkey").alias("high"))


@query("""
SELECT o_orderstatus, count(*) AS n, sum(CAST(round(o_totalprice * 100) AS BIGINT))::BIGINT AS cents
FROM orders GROUP BY 1""")
def incremental_append(spark, sf_dir):
    """The first half of the keys, then what lies above the mark, then nothing new."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", to_cents("o_totalprice").alias("cents"))
    path = scratch_path(spark, "increment")
    middle = orders.agg((F.max("o_orderkey") / 2).alias("m")).scalar()
    append_increment(orders.filter(F.col("o_orderkey") <= middle), "o_orderkey", path)
    append_increment(orders, "o_orderkey", path)
    append_increment(orders, "o_orderkey", path)
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.sum("cents").alias("cents"))


@query("""
SELECT page_id, regexp_extract(url, '//([^/]+)', 1) AS host, '-' AS identity, '-' AS user,
       '[day ' || page_id || ']' AS time, '"GET ' || url || ' HTTP/1.1"' AS request, '200' AS status,
       CASE WHEN page_id % 5 = 0 THEN '-' ELSE CAST(length(html) AS VARCHAR) END AS size
FROM pages""")
def regex_table(spark, sf_dir):
    """Access-log lines split into seven fields; '-' is allowed."""
    line = F.concat(
        F.regexp_extract("url", "//([^/]+)", 1), F.lit(" - - [day "),
        F.col("page_id").cast("string"), F.lit('] "GET '), F.col("url"),
        F.lit(' HTTP/1.1" 200 '), F.when(F.col("page_id") % 5 == 0, "-").otherwise(
            F.length("html").cast("string")))
    return split_by_regex(table(spark, sf_dir, "pages").select("page_id", line.alias("line")),
                          "line", ACCESS_LOG_PATTERN, ACCESS_LOG_FIELDS, ["page_id"])


@query("WITH " + ACT_SQL + """
SELECT k, count(*) AS n, sum(cents)::BIGINT AS cents FROM act GROUP BY k""")
def json_props(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(to_cents("value").alias("cents"), "props")
    return json_table(e, "props", "k int", ["cents"]).groupBy("k").agg(
        F.count("*").alias("n"), F.sum("cents").alias("cents"))


@query("""
SELECT user_id, event_id, CAST(r AS INT) AS rank FROM (
  SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS r
  FROM events) WHERE r <= 3""")
def latest_per_key(spark, sf_dir):
    """The three newest events of every user."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    return latest_of(e, ["user_id"], [F.desc("ts"), "event_id"], 3).drop("ts")


@query("""
SELECT upper(regexp_replace(c_mktsegment, '[^A-Za-z]', '', 'g')) || '#' ||
         lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(6, length(CAST(c_custkey AS VARCHAR))) AS INT), '0')
         AS row_key,
       c_name, c_nationkey, c_acctbal
FROM customer""")
def row_key_view(spark, sf_dir):
    view = key_view(table(spark, sf_dir, "customer"), "c_mktsegment", "c_custkey",
                    {"profile": ["c_name", "c_nationkey"], "outcome": ["c_acctbal"]})
    return view.select("row_key", "profile.*", "outcome.*")


@query("""
SELECT c_nationkey, count(*) AS n FROM customer
WHERE starts_with(upper(regexp_replace(c_mktsegment, '[^A-Za-z]', '', 'g')) || '#', 'MACHINERY#')
GROUP BY 1""")
def prefix_scan(spark, sf_dir):
    """All rows under one row-key prefix; the keys are stored sorted."""
    view = key_view(table(spark, sf_dir, "customer"), "c_mktsegment", "c_custkey",
                    {"profile": ["c_nationkey"]})
    stored = write_parquet(view, scratch_path(spark, "row-keys"))
    return scan_prefix(stored, "MACHINERY#").groupBy("profile.c_nationkey").agg(
        F.count("*").alias("n"))
