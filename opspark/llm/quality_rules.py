"""Quality rules: per-document figures, and lines that too many documents of a host share.

Each document's distinct normalised lines (lower-case A-Z, single blanks) are
hashed and counted per host. A line in more than ``line_share`` of the host's
documents, and in more than ``line_docs`` of them, is boilerplate and is removed; so
is a line in more than ``line_most`` of them, however large the host.
A document that loses more than ``lost_share`` of its words with them is depleted.
Copies of one text count as one document, so a group of copies is no evidence of
boilerplate: it is left to the stage that removes duplicates.

Counts are combined map-side (a hot host or line is one row per task). A host has
at most lines-per-document / line_share such lines, so the table that goes back to
the documents is small; it is stored first, and broadcast only if its size allows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opspark.llm.common import (ROW, batch_of, carried, mix, named, slices, small_batches, stored,
                                uncarried, word_hash)
from opspark.llm.substring import M1, M2

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Rules:
    """The production limits."""

    min_words: int = 50
    max_repeat_pct: int = 50
    line_share: float = 0.1
    line_docs: int = 20
    line_most: int = 10_000
    lost_share: float = 0.5


def line_key(line: bytes) -> int | None:
    """Signed 64-bit hash of the normalised line; None without a word."""
    words = line.lower().split()
    if not words:
        return None
    value = xxhash.xxh3_64_intdigest(b" ".join(words))
    return value - 2**64 if value >= 2**63 else value


def repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that the text has twice or more."""
    n = len(words)
    if n < 4:
        return 0
    h = word_hash().of(words)
    with np.errstate(over="ignore"):
        three = mix(mix(h[:-2] * M1 + h[1:-1]) * M2 + h[2:])
    order = np.argsort(three, kind="stable")
    same = three[order][1:] == three[order][:-1]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(n, bool)
    for k in range(3):
        cover[k:n - 2 + k] |= twice
    return int(cover.sum())


def figures(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    chars = len(text) - sum(raw.count(b) for b in BLANKS)
    symbols = sum(raw.count(s) for s in SYMBOLS)
    seen: set[bytes] = set()
    dup = 0
    for line in raw.split(b"\n"):
        if line.strip():
            dup += line in seen
            seen.add(line)
    return len(words), chars, symbols, dup, repeat_words(words)


LINES = pa.schema([("host", pa.string()), ("copy", pa.int64()), ("line", pa.int64())])


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct line hashes of each document; line null: the document itself."""
    for batch in slices(batches):
        host, copy, line = [], [], []
        for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            raw = (text or "").encode("utf-8", "replace")
            own = xxhash.xxh3_64_intdigest(raw) - 2**63
            keys = {k for k in map(line_key, raw.split(b"\n")) if k is not None}
            host.extend([h] * (len(keys) + 1))
            copy.extend([own] * (len(keys) + 1))
            line.append(None)
            line.extend(keys)
        if host:
            yield batch_of(LINES, host=host, copy=copy, line=line)


def frequent_lines(docs: DataFrame, host_col: str, text_col: str, rules: Rules) -> DataFrame:
    """(host, lines array<long>): each host's lines above the limits, stored."""
    rows = docs.select(F.coalesce(named(host_col).cast("string"), F.lit("")).alias("host"),
                       named(text_col).cast("string").alias("text"))
    rows = rows.mapInArrow(_lines, "host string, copy long, line long").distinct()
    counts = stored(rows.groupBy("host", "line").agg(F.count("*").alias("n")), "lines")
    size = counts.filter("line IS NULL").select("host", F.col("n").alias("size"))
    over = (counts.filter((F.col("n") > rules.line_docs) & F.col("line").isNotNull())
            .join(size, "host").filter((F.col("n") > F.col("size") * rules.line_share)
                                       | (F.col("n") > rules.line_most)))
    return stored(over.groupBy("host").agg(F.collect_list("line").alias("lines")), "frequent")


def judge(text: str | None, lines: list[int] | None, rules: Rules):
    """(figures, base_failed, words lost, kept, text without the frequent lines)."""
    got = figures(text)
    n, repeat = got[0], got[4]
    failed = n < rules.min_words or 100 * repeat > rules.max_repeat_pct * n
    lost, clean = 0, text
    if lines and text:
        frequent, left = set(lines), []
        for line in text.split("\n"):
            raw = line.encode("utf-8", "replace")
            if line_key(raw) in frequent:
                lost += len(raw.split())
            else:
                left.append(line)
        clean = "\n".join(left) if lost else text
    return got, failed, lost, not failed and lost <= rules.lost_share * n, clean


def screen(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           host_col: str = "source", rules: Rules = Rules()) -> DataFrame:
    """One row per row of ``docs``: the figures, the verdict and the cleaned text.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, n_lost (words in removed lines), clean_text (without the
    removed lines; the text itself where none goes). A null text is empty and
    fails; a null host is the host ''; repeated rows are judged alike. Further
    columns are ignored.
    """
    small_batches(docs.sparkSession)
    frequent = frequent_lines(docs, host_col, text_col, rules)
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()),
        ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
        ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("n_lost", pa.int64()),
        ("clean_text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for doc_id, text, lines in zip(*(c.to_pylist() for c in batch.columns)):
                got, failed, lost, kept, clean = judge(text, lines, rules)
                out.append((doc_id, *got, failed, kept, lost, clean))
            if out:
                yield batch_of(schema, **dict(zip(schema.names, zip(*out))))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"),
                       F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"))
    return (rows.join(frequent, "host", "left").select("doc_id", "text", "lines")
            .mapInArrow(run, "doc_id long, n_words long, word_chars long, n_symbols long, "
                        "n_dup_lines long, n_repeat_words long, base_failed boolean, "
                        "kept boolean, n_lost long, clean_text string"))


def keep_good(docs: DataFrame, text_col: str = "text", host_col: str = "source",
              rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that pass, with the frequent lines taken out of their text.

    Columns stay as they are, whatever their names; rows are judged as in ``screen``, so
    null and empty texts go, repeated rows stay or go together, and an empty table stays
    empty.
    """
    small_batches(docs.sparkSession)
    rows = carried(docs, text=named(text_col).cast("string"),
                   host=F.coalesce(named(host_col).cast("string"), F.lit("")))
    frequent = frequent_lines(rows, "host", "text", rules)
    joined = rows.join(frequent, "host", "left").select(ROW, "text", "lines")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            done = [judge(t, lines, rules) for t, lines in zip(
                batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([d[4] for d in done], pa.string())], [ROW, "text"])
            yield out.filter(pa.array([d[3] for d in done], pa.bool_()))

    kept = joined.mapInArrow(run, joined.select(ROW, "text").schema)
    text = F.col("text").cast(docs.schema[text_col].dataType)
    return uncarried(kept, docs.columns, **{text_col: text})
