"""Secrets in whole texts: keyword prefilter, anchored patterns, embedded checksums.

An Aho-Corasick automaton finds the keywords in one pass. A pattern is tried only
where one of its keywords starts, anchored there; since every match starts with a
keyword, trying the hits from left to right and skipping those inside the match
before gives the leftmost non-overlapping matches of the whole text. Hexadecimal
runs have no keyword and are found as maximal runs.

Beyond the base kinds, tokens that embed a checksum are found and validated: the
last six characters are the CRC-32 of the body in base 62.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opspark.llm.common import slices, worker_cache

# Kinds in their order, keywords and patterns.
KINDS = ("assign", "access", "hex", "github", "npm")
BASE = KINDS[:3]
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
}
ASSIGN = (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
PATTERNS = {
    "assign": re.compile(ASSIGN, re.IGNORECASE | re.ASCII),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "github": re.compile(r"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    "npm": re.compile(r"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
}
HEX = re.compile(r"[0-9a-f]{16,}")
DIGITS62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum62(body: str) -> str:
    """CRC-32 of ``body`` as six base-62 digits."""
    value, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        out = DIGITS62[digit] + out
    return out


def _valid(kind: str, m: re.Match) -> bool:
    if kind == "assign":
        return len(m.group(2)) >= 12
    if kind == "access":
        return m.end() - m.start() >= 18
    return checksum62(m.group(1)[:30]) == m.group(1)[30:]


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every secret, in that order; code points, end exclusive."""
    low = text.lower() if text.isascii() else text.encode("utf-8", "replace").lower().decode()
    out, free = [], dict.fromkeys(PATTERNS, 0)
    for last, (kind, size) in worker_cache("secret_keywords", _automaton).iter(low):
        start = last - size + 1
        if start < free[kind]:
            continue
        if kind in ("github", "npm") and start and (text[start - 1].isalnum()
                                                    or text[start - 1] == "_"):
            continue
        m = PATTERNS[kind].match(text, start)
        if m:
            free[kind] = m.end()
            if _valid(kind, m):
                out.append((start, KINDS.index(kind), m.end()))
    out.extend((m.start(), 2, m.end()) for m in HEX.finditer(text))
    return sorted(out)


SPAN = "array<struct<start:long,rank:int,stop:long,kind:string>>"


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans (start, rank, stop, kind), sorted, of each row's whole text.

    A null text is empty; a row without an id keeps its null; repeated rows give
    repeated results. Further columns are ignored.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("rank", pa.int32()),
                               ("stop", pa.int64()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            spans = [[{"start": s, "rank": k, "stop": e, "kind": KINDS[k]} for s, k, e in scan(t)]
                     if t else [] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)],
                                             ["doc_id", "spans"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"doc_id long, spans {SPAN}"))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
