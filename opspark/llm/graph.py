"""Connected components of a link table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opspark.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the component's least node.

    Alternating large-star and small-star steps: each node passes its least
    neighbour on, until every link points at a root. Every step is a grouped
    minimum (combined map-side) and a join on the node, so a hub of any degree is
    never gathered; each round is stored, and the number of rounds grows with the
    logarithm of the component's diameter. Null ends and self-links are ignored.
    """
    edges = stored(links.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(low, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
            F.col("m").alias("v"))
        edges = stored(small.unionByName(low.select("u", F.col("m").alias("v")))
                       .filter("u <> v").distinct(), "links")
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return ends.unionByName(ends.select(F.col("root").alias("node"), "root").distinct())
