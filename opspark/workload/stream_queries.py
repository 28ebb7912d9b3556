"""Streams over the event table: what they end with equals the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from opspark.functions.columns import to_cents
from opspark.session import scratch_path
from opspark.streaming.streams import (
    run_available, run_batches, run_to_files, running_agg, stage_files, stream_json, stream_source,
    windowed_agg)
from opspark.workload.bindings import ACT_SQL
from opspark.workload.registry import query

EVENTS = ("event_id bigint, ts timestamp, user_id bigint, event_type string, value double, "
          "props string")


def _events(spark, sf_dir):
    return stream_source(spark, f"{sf_dir}/events*.parquet", EVENTS)


def _run(spark, df, name):
    return run_available(df, scratch_path(spark, name), scratch_path(spark, f"{name}-state"))


@query("""
SELECT event_type, count(*) AS n, sum(CAST(round(value * 100) AS BIGINT))::BIGINT AS cents
FROM events GROUP BY 1""")
def stream_running_agg(spark, sf_dir):
    """Running totals per key in complete mode, available now."""
    totals = running_agg(_events(spark, sf_dir), ["event_type"], [
        F.count("*").alias("n"), F.sum(to_cents("value")).alias("cents")])
    return _run(spark, totals, "running_agg")


@query("WITH " + ACT_SQL + "SELECT k, count(*) AS n, sum(cents)::BIGINT AS cents FROM act GROUP BY k")
def stream_json_agg(spark, sf_dir):
    """JSON messages of a stream, parsed and totalled."""
    messages = _events(spark, sf_dir).select(to_cents("value").alias("cents"), "props")
    totals = running_agg(stream_json(messages, "props", "k int", ["cents"]), ["k"], [
        F.count("*").alias("n"), F.sum("cents").alias("cents")])
    return _run(spark, totals, "json_agg")


@query("""
WITH d AS (SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2)
SELECT strftime(day, '%Y-%m-%d') AS day, event_type, n FROM d
WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""")
def stream_daily(spark, sf_dir):
    """Event-time days that the watermark has closed, written exactly once."""
    daily = windowed_agg(_events(spark, sf_dir), "ts", "1 day", "1 hour", ["event_type"],
                         [F.count("*").alias("n")])
    daily = daily.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"),
                         "event_type", "n")
    return run_to_files(daily, scratch_path(spark, "daily"), scratch_path(spark, "daily-state"))


@query("""
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n,
       sum(CAST(round(value * 100) AS BIGINT))::BIGINT AS cents
FROM events GROUP BY 1, 2""")
def stream_daily_all(spark, sf_dir):
    """Every event-time day, open ones too: the complete result, equal to the batch one."""
    daily = windowed_agg(_events(spark, sf_dir), "ts", "1 day", "1 hour", ["event_type"],
                         [F.count("*").alias("n"), F.sum(to_cents("value")).alias("cents")])
    return _run(spark, daily.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"),
                                    "event_type", "n", "cents"), "daily_all")


STAGED_SQL = """
SELECT event_type, count(*) AS n, sum(CAST(round(value * 100) AS BIGINT))::BIGINT AS cents
FROM events GROUP BY 1"""


@query(STAGED_SQL)
def stream_staged(spark, sf_dir):
    """A stream of many files in batches of two, stopped half-way and started again."""
    staged = stage_files(spark.read.schema(EVENTS).parquet(f"{sf_dir}/events*.parquet"),
                         scratch_path(spark, "staged"), 6)
    totals = running_agg(stream_source(spark, staged, EVENTS, files_per_batch=2), ["event_type"], [
        F.count("*").alias("n"), F.sum(to_cents("value")).alias("cents")])
    place, state = scratch_path(spark, "totals"), scratch_path(spark, "totals-state")
    run_batches(totals, place, state, 1)
    return run_available(totals, place, state)


@query("WITH t AS (" + STAGED_SQL + """)
SELECT c AS consumer, event_type, n, CASE WHEN c = 'money' THEN cents END AS cents
FROM t, (VALUES ('counts'), ('money')) v(c)""")
def stream_consumers(spark, sf_dir):
    """Two consumers of one source, each from its own checkpoint: one is stopped and resumed,
    the other starts only when the first is done, and reads all from the beginning."""
    staged = stage_files(spark.read.schema(EVENTS).parquet(f"{sf_dir}/events*.parquet"),
                         scratch_path(spark, "staged"), 4)
    source = stream_source(spark, staged, EVENTS, files_per_batch=1)
    both = {"counts": [F.count("*").alias("n"), F.lit(None).cast("long").alias("cents")],
            "money": [F.count("*").alias("n"), F.sum(to_cents("value")).alias("cents")]}
    out = None
    for name, aggs in both.items():
        place, state = scratch_path(spark, name), scratch_path(spark, f"{name}-state")
        totals = running_agg(source, ["event_type"], aggs)
        if name == "counts":
            run_batches(totals, place, state, 2)
        part = run_available(totals, place, state).select(F.lit(name).alias("consumer"), "*")
        out = part if out is None else out.unionByName(part)
    return out
