"""Near-duplicate documents by an inverted join on MinHash coordinates.

A signature has ``POSTED`` coordinates that are posted under their (coordinate,
value) pair and ``FINE`` more that only sharpen the count of collisions. Two
documents over the match threshold collide in at least ``MATCH`` posted
coordinates, so they meet in one of the ``POSTED - MATCH + 1`` rarest values of
either (the prefix); the longer lists are skipped and never merged. A pair is
counted in the first list it shares, and goes on when its fine coordinates agree
often enough. Links are then confirmed on the full shingle sets.

Copies with equal sets are one node from the start. Long lists are cut into
blocks, so no task holds a group. The first round keeps, inside a block, only a
best spanning forest of the pairs; confirmed, these links join nearly all of a
large group. The second round tests every pair over the threshold whose ends are
still apart. So no link is lost, and pairs inside a group are not written out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opspark.llm.common import (ROW, batch_of, carried, grouped, mix, named, slices, small_batches,
                                stored, uncarried, word_hash)
from opspark.llm.graph import components

SHINGLE = 5
PERCENT = 85  # links have 100 * intersection >= PERCENT * union
# At a similarity of 0.85, 32 coordinates miss 14 collisions, or 512 miss 398, for
# about one pair in 10^7 and one in 10^5; pairs well above the limit never do.
POSTED, MATCH = 32, 14
FINE, FINE_MATCH = 512, 398
BLOCK = 512

_random = np.random.default_rng(20240229)
ODD = (_random.integers(0, 2**32, POSTED + FINE, np.uint32) | np.uint32(1))[:, None]
FLIP = _random.integers(0, 2**32, POSTED + FINE, np.uint32)[:, None]
STEP = _random.integers(0, 2**63, SHINGLE, np.uint64) | np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of the lower-cased (A-Z) words."""
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = word_hash().of(words)
    with np.errstate(over="ignore"):
        if len(words) < SHINGLE:
            short = (h * STEP[:len(h)]).sum(dtype=np.uint64) + np.uint64(len(h))
            return mix(np.array([short]))
        n = len(h) - SHINGLE + 1
        total = h[:n] * STEP[0]
        for k in range(1, SHINGLE):
            total = total + mix(h[k:k + n]) * STEP[k]
        return np.unique(mix(total))


def signature(found: np.ndarray) -> bytes:
    """Minimum of each coordinate's scramble: POSTED uint32 values, then FINE bytes."""
    x = (found ^ (found >> np.uint64(32))).astype(np.uint32)
    low = np.full(POSTED + FINE, 0xFFFFFFFF, np.uint32)
    with np.errstate(over="ignore"):
        for at in range(0, len(x), 1024):
            np.minimum(low, ((x[at:at + 1024] ^ FLIP) * ODD).min(axis=1), out=low)
        fine = ((low[POSTED:] * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)
    return low[:POSTED].tobytes() + fine.tobytes()


SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("d1", pa.int64()),
                    ("d2", pa.int64()), ("sig", pa.binary())])


def _digest(found: np.ndarray) -> tuple[int, int]:
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), "<i8").tolist())


def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        out = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = shingles(text)
            d1, d2 = _digest(found) if len(found) else (None, None)
            out.append((doc_id, len(found), d1, d2, signature(found) if len(found) else None))
        if out:
            yield batch_of(SIGNED, **dict(zip(SIGNED.names, zip(*out))))


POSTS = pa.schema([("key", pa.int64()), ("nid", pa.int64())])


def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per posted coordinate: key = coordinate * 2^32 + value."""
    lane = np.arange(POSTED, dtype=np.int64) << 32
    for batch in slices(batches):
        nid = batch.column(0).to_numpy()
        keys = [lane + np.frombuffer(s, "<u4", POSTED).astype(np.int64)
                for s in batch.column(1).to_pylist()]
        if keys:
            yield batch_of(POSTS, key=np.concatenate(keys), nid=np.repeat(nid, POSTED))


PAIRS = pa.schema([("spot", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def _forest(n: int, pairs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    up = list(range(n))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    kept = []
    for pair in sorted(pairs, reverse=True):
        i, j = root(pair[1]), root(pair[2])
        if i != j:
            up[i] = j
            kept.append(pair)
    return kept


def collide(forest: bool):
    """Pairs inside each block (rows sorted by ``spot``) that reach the match threshold."""
    def inside(t: pa.Table) -> Iterator[pa.RecordBatch]:
        n, spot = t.num_rows, t["spot"][0].as_py()
        if n < 2:
            return
        number = {c: t[c].to_numpy() for c in ("nid", "n_shingles", "home", "comp", "mask")}
        lane = t["key"][0].as_py() >> 32
        apart = t["low"][0].as_py() != t["high"][0].as_py()
        raw = np.array(t["sig"].to_pylist(), dtype=f"S{POSTED * 4 + FINE}")
        raw = raw.view(np.uint8).reshape(n, -1)
        value = raw[:, :POSTED * 4].copy().view("<u4")
        fine = raw[:, POSTED * 4:]
        bits = ((number["mask"][:, None] >> np.arange(POSTED)) & 1).astype(bool)
        size, pairs = number["n_shingles"], []
        for i in range(n - 1):
            j = np.arange(i + 1, n)
            ok = number["comp"][j] != number["comp"][i]
            ok &= (100 * np.minimum(size[i], size[j]) >= PERCENT * np.maximum(size[i], size[j]))
            if apart:
                ok &= number["home"][j] != number["home"][i]
            j = j[ok]
            if len(j) and lane:  # a pair belongs to the first list it shares
                before = (value[j, :lane] == value[i, :lane]) & bits[j, :lane] & bits[i, :lane]
                j = j[~before.any(axis=1)]
            if len(j):
                agree = (fine[j] == fine[i]).sum(axis=1)
                ok = agree >= FINE_MATCH
                pairs.extend((int(s), i, int(k)) for s, k in zip(agree[ok], j[ok]))
        if forest:
            pairs = _forest(n, pairs)
        if pairs:
            nid = number["nid"]
            yield batch_of(PAIRS, spot=[spot] * len(pairs), a=[nid[p[1]] for p in pairs],
                           b=[nid[p[2]] for p in pairs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped(batches, "spot"):
            yield from inside(t)

    return run


SETS = pa.schema([("nid", pa.int64()), ("found", pa.binary())])


def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = batch.to_pydict()
        out = {}
        for nid, d1, d2, text in zip(rows["nid"], rows["d1"], rows["d2"], rows["text"]):
            found = shingles(text)
            if len(found) and _digest(found) == (d1, d2):  # another text of that id is not it
                out[nid] = found.tobytes()
        if out:
            yield batch_of(SETS, nid=list(out), found=list(out.values()))


DIGESTED = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("found", pa.binary())])


def digested_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        out = {_digest(found): found.tobytes()
               for found in map(shingles, batch.column(0).to_pylist()) if len(found)}
        if out:
            yield batch_of(DIGESTED, d1=[d[0] for d in out], d2=[d[1] for d in out],
                           found=list(out.values()))


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each block, from its sets (b null) and its pairs."""
    for t in grouped(batches, "spot"):
        rows = t.to_pydict()
        sets = {a: np.frombuffer(s, np.uint64) for a, s in zip(rows["a"], rows["found"]) if s}
        good = []
        for a, b in zip(rows["a"], rows["b"]):
            if b is not None:
                x, y = sets[a], sets[b]
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= PERCENT * (len(x) + len(y) - common):
                    good.append((a, b))
        if good:
            yield batch_of(LINKS, a=[g[0] for g in good], b=[g[1] for g in good])


def _meet(posts: DataFrame, forest: bool) -> DataFrame:
    """Candidate pairs of the prefix lists, block by block."""
    blocks = F.ceil(F.col("cnt") / BLOCK).cast("long")
    placed = (posts.withColumn("home", F.pmod(F.xxhash64("nid"), blocks))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
              .withColumn("low", F.least("home", "other"))
              .withColumn("high", F.greatest("home", "other"))
              .withColumn("spot", F.xxhash64("key", "low", "high"))
              .select("spot", "key", "low", "high", "nid", "n_shingles", "home", "comp", "mask",
                      "sig"))
    return (placed.repartition("spot").sortWithinPartitions("spot", "key", "low", "high")
            .mapInArrow(collide(forest), "spot long, a long, b long"))


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    ends = pairs.select("spot", F.explode(F.array("a", "b")).alias("nid")).distinct()
    rows = (ends.join(sets, "nid")
            .select("spot", F.col("nid").alias("a"), F.lit(None).cast("long").alias("b"), "found")
            .unionByName(pairs.withColumn("found", F.lit(None).cast("binary"))))
    return (rows.repartition("spot").sortWithinPartitions("spot")
            .mapInArrow(confirm, "a long, b long"))


MOST_BITS = 28  # the bit table's size is at most 2^28 bits (32 MB), whatever the corpus' size
BITMAP = 1 << 15  # bits in one of Spark's bitmaps


def may_hold(source: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``source`` (doc_id, text) whose doc_id has its bit in a table of the wanted ones.

    None of these is lost, and at sixteen bits for each wanted id few others stay, so a join
    with ``wanted`` has no need to shuffle all texts.
    """
    bits = 1 << min(MOST_BITS, max(15, (16 * wanted.count()).bit_length()))
    at = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    table = np.zeros(bits // 8, np.uint8)
    found = wanted.select((at + 1).alias("at")).groupBy(F.bitmap_bucket_number("at").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("v"))
    for r in found.toLocalIterator():  # at most 4 kB a row, and the table in all
        first = (r.part - 1) * BITMAP // 8
        table[first:first + len(r.v)] = np.frombuffer(r.v, np.uint8)
    held = source.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column(2).to_numpy()
            kept = (held.value[place >> 3] >> (place & 7).astype(np.uint8)) & 1
            yield batch.select([0, 1]).filter(pa.array(kept.astype(bool)))

    return source.select("doc_id", "text", at.alias("at")).mapInArrow(run, "doc_id long, text string")


def _sets(source: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(nid, found), stored: the full sets of the nodes in ``pairs`` (a, b, or nid)."""
    ends = pairs if "nid" in pairs.columns else pairs.select(F.explode(F.array("a", "b")).alias("nid"))
    # Stored, as it is read three times.
    wanted = stored(nodes.join(ends.distinct(), "nid", "left_semi")
                    .select(F.col("rep").alias("doc_id"), "nid", "d1", "d2"), "wanted")
    sets = (may_hold(source, wanted).join(wanted, "doc_id").select("nid", "d1", "d2", "text")
            .mapInArrow(full_sets, "nid long, found binary"))
    unnamed = wanted.filter("doc_id IS NULL")
    if not unnamed.isEmpty():  # a node whose texts have no id finds its set by its digests
        sets = sets.unionByName(
            source.filter("doc_id IS NULL").select("text")
            .mapInArrow(digested_sets, "d1 long, d2 long, found binary")
            .dropDuplicates(["d1", "d2"]).join(unnamed, ["d1", "d2"]).select("nid", "found"))
    return stored(sets, "sets")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``.

    Rows stand for documents, also where an id repeats. A null or wordless text
    has no shingles and is linked with nothing; a row without an id takes part,
    but cannot name its component (its component_id may be null, it is then kept
    only if it is alone). Further columns are ignored.
    """
    small_batches(docs.sparkSession)
    source = docs.select(named(id_col).cast("long").alias("doc_id"),
                         named(text_col).cast("string").alias("text"))
    signed = stored(source.mapInArrow(
        sign, "doc_id long, n_shingles long, d1 long, d2 long, sig binary"), "signed")
    nodes = stored(signed.filter("n_shingles > 0").groupBy("d1", "d2").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"),
        F.first("sig").alias("sig")).withColumn("nid", F.monotonically_increasing_id()), "nodes")

    posted = nodes.select("nid", "sig").mapInArrow(post, "key long, nid long")
    lists = posted.groupBy("key").agg(F.count("*").alias("cnt")).filter("cnt > 1")
    # A value of one document alone is the rarest of all and fills the prefix first.
    room = F.lit(POSTED - MATCH + 1 - POSTED) + F.size("all")
    prefix = (posted.join(lists, "key").groupBy("nid")
              .agg(F.sort_array(F.collect_list(F.struct("cnt", "key"))).alias("all"))
              .filter(room > 0).select("nid", F.slice("all", F.lit(1), room).alias("prefix")))
    lane = F.shiftright(F.col("p.key"), 32).cast("int")
    ready = stored(
        prefix.withColumn("mask", F.aggregate(
            "prefix", F.lit(0).cast("long"),
            lambda m, p: m + F.expr("1L") * F.pow(F.lit(2), F.shiftright(p["key"], 32))
            .cast("long")))
        .join(nodes, "nid")
        .select("nid", "n_shingles", "sig", "mask", "rep", "d1", "d2", "prefix"), "prefix")
    posts = ready.select("nid", "n_shingles", "sig", "mask",
                         F.explode("prefix").alias("p")).select("*", "p.cnt", "p.key").drop("p")

    first = stored(_meet(posts.withColumn("comp", F.col("nid")), True), "pairs")
    sets = _sets(source, ready, first)
    links = stored(_links(first, sets), "links")
    joined = components(links).withColumnRenamed("node", "nid")
    labelled = (posts.join(joined, "nid", "left")
                .withColumn("comp", F.coalesce("root", "nid")).drop("root"))
    mixed = (labelled.groupBy("key").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2"))
             .filter("c1 <> c2").select("key"))
    second = stored(_meet(labelled.join(mixed, "key", "left_semi"), False), "pairs")
    more = second.select(F.explode(F.array("a", "b")).alias("nid")).distinct().join(
        sets, "nid", "left_anti")
    if not more.isEmpty():
        sets = sets.unionByName(_sets(source, ready, more))
    links = links.unionByName(_links(second, sets))
    final = components(links).withColumnRenamed("node", "nid")

    own = nodes.select("nid", "d1", "d2", "rep").join(final, "nid", "left")
    least = (own.filter(F.col("root").isNotNull()).groupBy("root")
             .agg(F.min("rep").alias("least")))
    called = own.join(least, "root", "left").select(
        "d1", "d2", F.coalesce("least", "rep").alias("component_id"))
    return (signed.select("doc_id", "n_shingles", "d1", "d2").join(called, ["d1", "d2"], "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("n_shingles") > 0, F.col("component_id"))
                    .otherwise(F.col("doc_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group the least id stays.

    Of rows that share an id the one with the least text stays (of equal texts any one).
    Rows without an id cannot be told apart and stay, as do null and empty texts. An empty
    table stays empty, and all columns stay as they are, whatever their names.
    """
    unnamed = docs.filter(named(id_col).isNull())
    rows = carried(docs.filter(named(id_col).isNotNull()), doc_id=named(id_col).cast("long"),
                   text=named(text_col).cast("string"))
    kept = near_duplicates(rows).filter("kept").select("doc_id").distinct()
    # One row per id before the shuffle: an id of very many rows is combined map-side.
    one = rows.groupBy("doc_id").agg(F.min_by(ROW, "text").alias(ROW), F.first(ROW).alias("any"))
    first = one.join(kept, "doc_id", "left_semi").withColumn(ROW, F.coalesce(ROW, "any"))
    return uncarried(first, docs.columns).unionByName(unnamed)
