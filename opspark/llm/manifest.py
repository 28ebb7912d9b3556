"""A Merkle manifest of a table: leaf digests, a root per group, one root, and proofs.

Rows are leaves, ordered inside their group. Every 16 consecutive nodes hash to one of
the next level, until a group has one node, its subroot; the subroots hash to the root
in the same way. Ranks in base 16 say where a node stands: grouping away the last
digit, then the one before, then the third, nests a block of up to 4096 nodes into one
struct, in one shuffle. The blocks' digests are the nodes of the next rollup.

Proofs go the other way: the blocks of each level meet the paths of their own nodes in
one grouping, and a transform and an explode for each digit hand every child its
siblings. There is no join of rows with their ancestors, no row holds more than a
block, and ranks come from range partitions, so a group of any size is spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opspark.llm.common import stored

FAN, DIGITS = 16, 3
BLOCK = FAN ** DIGITS
STEP = "struct<left: string, right: string>"


def field(value: Column) -> Column:
    """One field of a leaf: ``-`` if null, else its UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(columns: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of the fields of a row."""
    return F.sha2(F.concat(*map(field, columns)), 256)


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf digest leads to over the steps of its path."""
    return F.aggregate(path, digest,
                       lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]), 256))


def path_text(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def ranked(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """``nodes`` with their rank (from 0) inside ``grp`` and the group's size ``n``.

    Rows are dealt into ranges of (grp, order); a range's place in its partition is
    stored with it, and the few (partition, group) totals say what came before.
    """
    placed = stored(nodes.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
                    .withColumn("place", F.monotonically_increasing_id())
                    .withColumn("part", F.spark_partition_id()), "ranked")
    # A group has one row per partition here: a small window.
    inside = W.partitionBy("grp")
    before = inside.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    shift = (placed.groupBy("part", "grp").agg(F.min("place").alias("first"),
                                               F.count("*").alias("here"))
             .select("part", "grp", F.sum("here").over(inside).alias("n"),
                     (F.coalesce(F.sum("here").over(before), F.lit(0)) - F.col("first"))
                     .alias("shift")))
    return (placed.join(shift, ["part", "grp"])
            .withColumn("rank", F.col("place") + F.col("shift"))
            .drop("part", "place", "shift"))


def _parent(kids: str, digest: str, hashed: Column) -> Column:
    """H of the children, or the only child's digest where the level is the top already."""
    digests = F.transform(kids, lambda k: k[digest])
    return F.when(hashed, F.sha2(F.array_join(digests, ""), 256)).otherwise(digests[0])


def rollup(nodes: DataFrame) -> DataFrame:
    """One row per block of nodes (grp, n, rank, digest, load): grp, n, block, digest, kids."""
    digit = [F.shiftright("rank", 4 * k).bitwiseAND(FAN - 1).cast("int") for k in range(DIGITS)]
    keys = ["grp", "n", "block", *[f"d{k}" for k in range(DIGITS - 1, 0, -1)]]
    level = (nodes.select("grp", "n", F.shiftright("rank", 4 * DIGITS).alias("block"),
                          *[d.alias(f"d{k}") for k, d in enumerate(digit)], "digest", "load")
             .repartition("grp", "block"))
    below = "load"
    for k in range(DIGITS):  # the keys hold the partitioning's: one shuffle for all digits
        kids = F.sort_array(F.collect_list(F.struct(f"d{k}", "digest", F.col(below).alias("below"))))
        level = level.groupBy(*keys).agg(kids.alias("kids"))
        level = level.withColumn("digest", _parent("kids", "digest", F.col("n") > FAN ** k))
        below, keys = "kids", keys[:-1]
    return stored(level.select("grp", "n", "block", "digest", "kids"), "blocks")


def climb(nodes: DataFrame) -> list[DataFrame]:
    """The blocks of each rollup, from the leaves up to one block in each group."""
    most = nodes.agg(F.max("n")).first()[0] or 1
    tables = [rollup(nodes)]
    while most > BLOCK:
        most = -(-most // BLOCK)
        tables.append(rollup(tables[-1].select(
            "grp", F.ceil(F.col("n") / BLOCK).alias("n"), F.col("block").alias("rank"), "digest",
            F.lit(0).alias("load"))))
    return tables


def _open(rows: DataFrame, k: int) -> DataFrame:
    """A row per child, its siblings put before the steps of its parent."""
    hashed = F.col("n") > FAN ** k
    rows = rows.withColumn("digests", F.transform("kids", lambda x: x["digest"]))

    def side(a: Column | int, n: Column | int) -> Column:
        return F.array_join(F.slice("digests", a, n), "")

    def child(x: Column, i: Column) -> Column:
        step = F.array(F.struct(side(F.lit(1), i).alias("left"),
                                side(i + 2, F.lit(FAN)).alias("right")))
        return F.struct(x.alias("node"), F.concat(
            F.when(hashed, step).otherwise(F.array().cast(f"array<{STEP}>")),
            F.col("path")).alias("path"))

    opened = rows.select("grp", "n", "rank", "subroot", "root",
                         F.explode(F.transform("kids", child)).alias("kid"))
    return opened.select(
        "grp", "n", (F.col("rank") * FAN + F.col(f"kid.node.d{k}")).alias("rank"), "subroot",
        "root", F.col("kid.path").alias("path"), F.col("kid.node.digest").alias("digest"),
        F.col("kid.node.below").alias("kids"))


def descend(tables: list[DataFrame], above: DataFrame) -> DataFrame:
    """Every node under ``above`` (grp, rank, path, subroot, root) with its own path.

    Returns grp, n, rank, subroot, root, path, digest and load.
    """
    for blocks in reversed(tables):
        both = (blocks.select("grp", "n", F.col("block").alias("rank"), "kids")
                .unionByName(above.select("grp", "rank", "path", "subroot", "root"),
                             allowMissingColumns=True).repartition("grp", "rank"))
        met = both.groupBy("grp", "rank").agg(
            *[F.first(c, ignorenulls=True).alias(c)
              for c in ("n", "kids", "path", "subroot", "root")])
        for k in range(DIGITS - 1, -1, -1):
            met = _open(met, k)
        above = met
    return met.withColumnRenamed("kids", "load")


def proofs(leaves: DataFrame, order: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Each leaf with subroot, root and path (its siblings left and right, level by level).

    ``leaves`` has grp (a group's name; null is a group and comes first), digest, and the
    columns of ``order`` and ``carry``, which are returned too. Leaves of equal order are
    placed by their digest, so repeated rows have neighbouring leaves of their own; null
    order values come first. Groups are ordered by the bytes of their names. A lone leaf is
    its subroot, a lone subroot is the root; no rows have no root and no proofs.
    """
    held = list(dict.fromkeys([*order, *carry]))
    # A name with a mark before it: null becomes '', which sorts first and joins like any other.
    named = F.coalesce(F.concat(F.lit("g"), F.col("grp").cast("string")), F.lit(""))
    narrow = stored(leaves.select(named.alias("grp"), "digest",
                                  F.struct(*[F.col(f"`{c}`") for c in held]).alias("load")), "leaves")
    sort = [f"load.{c}" for c in order]
    trees = climb(ranked(narrow, [*sort, "digest"]))
    tops = trees[-1].select(F.lit("").alias("grp"), "digest", F.col("grp").alias("load"))
    crown = climb(ranked(tops, ["load"]))
    root = crown[-1].select("grp", F.col("block").alias("rank"),
                            F.array().cast(f"array<{STEP}>").alias("path"),
                            F.lit("").alias("subroot"), F.col("digest").alias("root"))
    subroots = descend(crown, root).select(
        F.col("load").alias("grp"), F.lit(0).cast("long").alias("rank"), "path",
        F.col("digest").alias("subroot"), "root")
    found = descend(trees, subroots)
    name = F.when(F.col("grp") != "", F.substring("grp", 2, 2**31 - 1))
    return found.select(name.alias("grp"), *[F.col(f"load.`{c}`").alias(c) for c in held],
                        F.col("digest").alias("leaf"), "subroot", "root", "path")


def audit(docs: DataFrame, changed: Column, text: Column) -> DataFrame:
    """Proofs of the documents, and whether they hold after a change.

    Where ``changed`` is true a row's text is replaced by ``text`` before its leaf is
    computed again; the proof stays that of the original. Returns doc_id, leaf, subroot,
    root, path, folded_root and verified. Null fields are leaves' ``-``; empty and very
    long texts are hashed whole; further columns are not part of a leaf.
    """
    rows = docs.select(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"),
                       F.col("text"))
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaves = rows.select(
        F.col("source").alias("grp"), "doc_id", leaf([*fields, F.col("text")]).alias("digest"),
        F.when(changed, leaf([*fields, text])).alias("again"))
    found = proofs(leaves, ["doc_id"], ["again"])
    folded = fold(F.coalesce("again", "leaf"), F.col("path"))
    return (found.withColumn("folded_root", folded)
            .select("doc_id", "leaf", "subroot", "root", "path", "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified")))
