"""Benchmark passages in documents, also with edits: pigeonhole pieces and Myers' distance.

An item of m characters may differ in k = error_pct % of m edits. Cut into k + 1
pieces, a copy with at most k edits keeps at least one piece unchanged, so an
Aho-Corasick pass over a document for all pieces misses no copy. Around each hit
the edit distance to the best-fitting stretch is computed with Myers' bit-parallel
recurrence, one machine word of any length (a Python integer).

The same pigeonhole holds for any run of s pieces with at most s - 1 edits: of its
two halves one is within its own budget. So a hit is verified from the piece
outwards, over runs of 2, 4, 8, ... pieces up to the whole item, each with one edit
less than it has pieces. Chance hits end at the first, short run; no copy is lost.

Texts and items are compared in normal form: lower case, letters and digits only,
single blanks. Items are sent to the tasks in blocks of bounded size; several
blocks mean several passes over the documents.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opspark.llm.common import (carried, named, slices, small_batches, uncarried,
                                worker_cache)

ERROR_PCT = 10
BLOCK_CHARS = 8_000_000
NOT_WORD = re.compile(r"[\W_]{2,}|[^\w\x20]|_")  # a single blank is what it becomes


def normal(text: str | None) -> str:
    return NOT_WORD.sub(" ", text.lower()).strip() if text else ""


def pieces(item: str, error_pct: int = ERROR_PCT) -> tuple[int, list[tuple[int, str]]]:
    """(k, [(place, piece)]): k + 1 pieces of nearly equal length."""
    k = len(item) * error_pct // 100
    edges = [len(item) * i // (k + 1) for i in range(k + 2)]
    return k, [(a, item[a:b]) for a, b in zip(edges, edges[1:])]


def masks(item: str) -> dict[str, int]:
    """Character -> bits of its places in ``item``."""
    at: dict[str, int] = {}
    for i, c in enumerate(item):
        at[c] = at.get(c, 0) | 1 << i
    return at


def myers(m: int, at: dict[str, int], text: str, limit: int) -> tuple[int, int] | None:
    """(distance, end) of the stretch of ``text`` nearest to the item, if within ``limit``.

    The item is given by its length and ``masks``. The stretch may start anywhere;
    the first end with the least distance is returned.
    """
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = full, 0, m, None
    for j, c in enumerate(text):
        eq = at.get(c, 0)
        same = eq | down
        diag = (((eq & up) + up) ^ up) | eq
        plus = down | ~(diag | up) & full
        minus = up & diag
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = plus << 1 & full, minus << 1 & full  # a stretch may start anywhere
        up = minus | ~(same | plus) & full
        down = plus & same
        if score <= limit and (best is None or score < best[0]):
            best = (score, j + 1)
            if score == 0:
                break
    return best


def runs(parts: list[tuple[int, str]], item: str) -> list[list[tuple[int, int, int, dict]]]:
    """For each piece the runs of pieces around it, smallest first, the whole item last.

    A run is (places before the piece, length, budget, masks).
    """
    around: list[list] = [[] for _ in parts]

    def halve(lo: int, hi: int) -> None:
        start, end = parts[lo][0], parts[hi - 1][0] + len(parts[hi - 1][1])
        bits = masks(item[start:end])
        for j in range(lo, hi):
            around[j].insert(0, (parts[j][0] - start, end - start, hi - lo - 1, bits))
        middle = (lo + hi) // 2
        for a, b in ((lo, middle), (middle, hi)):
            if 1 < b - a < hi - lo:
                halve(a, b)

    halve(0, len(parts))
    return around


def twin(item: str, place: int, size: int, run: tuple[int, int, int, dict]):
    """(shift, text) tests of which a run of two pieces passes one, or none for other runs.

    The piece is unchanged, so the one edit is in its neighbour: one half of that is
    unchanged too, at its place if it adjoins the piece, else within one of it.
    """
    before, length, budget, _ = run
    if budget != 1:
        return ()
    if before:  # the neighbour is on the left
        other, at = item[place - before:place], -before
        half = len(other) // 2
        return ((at + half, other[half:]), *((at + d, other[:half]) for d in (-1, 0, 1)))
    other = item[place + size:place + length]
    half = len(other) // 2
    return ((size, other[:half]), *((size + half + d, other[half:]) for d in (-1, 0, 1)))


class Finder:
    """The automaton of one block of items."""

    def __init__(self, items: list[tuple[int, str]], error_pct: int):
        self.ids = [i for i, _ in items]
        spots: dict[str, list[tuple[int, list, tuple]]] = {}
        for n, (_, text) in enumerate(items):
            _, parts = pieces(text, error_pct)
            for (place, part), path in zip(parts, runs(parts, text)):
                tests = twin(text, place, len(part), path[0])
                spots.setdefault(part, []).append((n, path, tests))
        self.tree = ahocorasick.Automaton()
        for part, where in spots.items():
            self.tree.add_word(part, (len(part), where))
        self.tree.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int]]:
        """(item_id, distance, end in the normal form) of each item that the text holds."""
        text, found, failed = normal(text), {}, set()
        for last, (size, where) in self.tree.iter(text) if len(self.tree) else ():
            first = last - size + 1
            for n, path, tests in where:
                whole = first - path[-1][0]
                if n in found or (n, whole) in failed:
                    continue
                if tests and not any(first + shift >= 0 and text.startswith(part, first + shift)
                                     for shift, part in tests):
                    continue
                for before, length, budget, bits in path:
                    a = max(0, first - before - budget)
                    got = myers(length, bits, text[a:first - before + length + budget], budget)
                    if got is None:
                        break
                else:
                    found[n] = (self.ids[n], got[0], a + got[1])
                    continue
                if length == path[-1][1]:  # the whole item was tried at this place
                    failed.add((n, whole))
        return sorted(found.values())


def item_blocks(items: DataFrame, id_col: str, text_col: str,
                block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items in normal form, in blocks of at most ``block_chars`` (or one item).

    Items without an id or without a letter or digit cannot be matched and are
    left out. A repeated item counts once; of one id's texts, each counts.
    """
    block, held = [], 0
    rows = (items.select(F.col(id_col).cast("long").alias("i"),
                         F.col(text_col).cast("string").alias("t"))
            .filter("i IS NOT NULL AND t IS NOT NULL").distinct().orderBy("i", "t"))
    for r in rows.toLocalIterator():
        text = normal(r.t)
        if not text:
            continue
        if block and held + len(text) > block_chars:
            yield block
            block, held = [], 0
        block.append((r.i, text))
        held += len(text)
    if block:
        yield block


LEAKS = "array<struct<item_id:long,distance:int,end:int>>"


def _flagged(docs: DataFrame, items: DataFrame, text_col: str, item_id: str, item_text: str,
             error_pct: int, block_chars: int) -> DataFrame:
    """The rows as ``_row``, beside ``leaks``: one pass for each block of items."""
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()),
                               ("end", pa.int32())]))
    small_batches(docs.sparkSession)
    result = carried(docs, text=named(text_col).cast("string"), leaks=F.lit(None).cast(LEAKS))

    def passes(source):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block, key = source.value
            # One finder in a worker at a time: another block's takes its place.
            finder = worker_cache("items", lambda: Finder(block, error_pct), key)
            for batch in slices(batches):
                leaks = []
                for text, before in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                    got = finder.find(text) if text else []
                    leaks.append((before or []) + [
                        {"item_id": i, "distance": d, "end": e} for i, d, e in got])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:2], pa.array(leaks, kind)], batch.schema.names)

        return run

    for block in item_blocks(items, item_id, item_text, block_chars):
        key = hashlib.sha1(repr((error_pct, block)).encode()).hexdigest()
        source = docs.sparkSession.sparkContext.broadcast((block, key))
        result = result.mapInArrow(passes(source), result.schema)
    return result.withColumn("leaks", F.coalesce("leaks", F.array().cast(LEAKS)))


def flag_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text", error_pct: int = ERROR_PCT,
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with a column ``leaks``: the items each whole text holds, by id.

    All rows and columns come back; a column named ``leaks`` before is replaced.
    A null or empty text holds nothing. Repeated rows are judged alike. Without items
    nothing is held; an empty table stays empty.
    """
    flagged = _flagged(docs, items, text_col, item_id, item_text, error_pct, block_chars)
    kept = [c for c in docs.columns if c != "leaks"]
    return uncarried(flagged, [*kept, "leaks"], leaks=F.col("leaks"))


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", error_pct: int = ERROR_PCT,
                  block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns as they were.

    As in ``flag_leaks``, a column named ``leaks`` before does not come back. Null and empty texts stay; repeated rows stay or go together.
    """
    flagged = _flagged(docs, items, text_col, item_id, item_text, error_pct, block_chars)
    return uncarried(flagged.filter(F.size("leaks") == 0), [c for c in docs.columns if c != "leaks"])


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          **names) -> DataFrame:
    """(doc_id, item_id, distance, end): one row per document and item it holds."""
    rows = docs.select(named(id_col).cast("long").alias("doc_id"), named(text_col).alias("text"))
    return (flag_leaks(rows, items, **names)
            .select("doc_id", F.explode("leaks").alias("l")).select("doc_id", "l.*"))
