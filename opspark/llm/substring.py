"""Removal of repeated passages, by level-wise doubling of repeated windows.

Level 1 looks at windows of half the judged length. It needs only anchors: of the
half windows inside each full window, the one with the least hash. Equal full
windows have equal anchors at equal places, so a full window can be repeated only
where its anchor is. Anchors seen once are gone at this point.

Level 2 extends what is left to the full length. The words around an anchor that
its full windows can reach are its context. Where a context was seen before, all
its windows were, and nothing more has to be compared. Only first contexts whose
anchor has another context too (the edges of passages) put their windows up for
comparison one by one. As windows that are judged have the full length, the
doubling ends there; ``repeats`` goes on from any length until nothing survives.

Counts and minima are combined map-side; joins are plain joins, which adaptive
execution splits where one passage owns many rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opspark.llm.common import batch_of, mix, slices, split_words, stored, word_hash

WINDOW = 20
LAST = 2**63 - 1  # the place of a row without an id: after all others
LEFT, RIGHT = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC2B2AE3D27D4EB4F)  # beyond the text
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
ALT = np.uint64(0xA0761D6478BD642F)


def window_hashes(h: np.ndarray, length: int, seed: np.uint64 = np.uint64(0)) -> np.ndarray:
    """Hash of each run of ``length`` words, by doubling runs of 1, 2, 4, ... words."""
    with np.errstate(over="ignore"):
        x, size = mix(h ^ seed) if seed else h, 1
        while size * 2 <= length:
            x = mix(x[:-size] * M1 + x[size:] * M2) if len(x) > size else x[:0]
            size *= 2
        rest = length - size
        if rest:
            x = mix(x[:-rest] * M1 + x[rest:] * M2) if len(x) > rest else x[:0]
        return x


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over each ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        x = pick(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return pick(x[:-rest], x[rest:]) if rest else x


def anchors(h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, hashes of half windows, least half-window hash of each full window)."""
    half = window // 2
    if len(h) < window:
        return np.empty(0, np.int64), h[:0], h[:0]
    short = window_hashes(h, half)
    width = window - half + 1
    least = _slide(short, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    best = _slide(np.concatenate([edge, least, edge]), width, np.maximum)
    return np.flatnonzero(short == best), short, least


def _tag(text: str) -> int:
    """Tells rows of one id with different texts apart."""
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=4).digest(),
                          "little")


ANCHORS = pa.schema([("h", pa.int64()), ("ctx", pa.int64()), ("doc", pa.int64()),
                     ("at", pa.int64())])


def find_anchors(window: int):
    """(anchor hash, context hash, document, place * 2^32 + tag) of every anchor."""
    reach = window - window // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hash()
        for batch in slices(batches):
            parts = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h = hashes.of(split_words(text))
                at, short, _ = anchors(h, window)
                if not len(at):
                    continue
                wide = np.concatenate([np.full(reach, LEFT), h, np.full(reach, RIGHT)])
                ctx = window_hashes(wide, window + reach, ALT)
                parts.append((short[at].view(np.int64), ctx[at].view(np.int64),
                              np.full(len(at), doc, np.int64), (at << 32) | _tag(text)))
            if parts:
                yield batch_of(ANCHORS, **{n: np.concatenate(c)
                                           for n, c in zip(ANCHORS.names, zip(*parts))})

    return run


PACKED = pa.schema([("doc", pa.int64()), ("tag", pa.int64()), ("doc_id", pa.int64()),
                    ("packed", pa.binary())])


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed before they are shuffled."""
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in slices(batches):
        ids, texts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        texts = [t or "" for t in texts]
        yield batch_of(PACKED, doc=batch.column(0), tag=[_tag(t) for t in texts], doc_id=ids,
                       packed=[squeeze.compress(t.encode("utf-8", "replace")) for t in texts])


def unpack(value: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(value).split()


WINDOWS = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("doc", pa.int64()),
                     ("at", pa.int64())])


def put_up(window: int):
    """The windows of the anchors that have to be compared one by one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hash()
        for batch in slices(batches):
            rows, parts = batch.to_pydict(), []
            for doc, tag, packed, at in zip(rows["doc"], rows["tag"], rows["packed"], rows["at"]):
                h = hashes.of(unpack(packed))
                _, short, least = anchors(h, window)
                width = window - window // 2 + 1
                near = (np.array(sorted(set(at)), np.int64)[:, None]
                        - np.arange(width, dtype=np.int64)[None, :])
                ok = (near >= 0) & (near < len(least))
                ok &= least[np.where(ok, near, 0)] == short[near[:, :1]]
                start = np.unique(near[ok])
                w1, w2 = window_hashes(h, window), window_hashes(h, window, ALT)
                parts.append((w1[start].view(np.int64), w2[start].view(np.int64),
                              np.full(len(start), doc, np.int64), (start << 32) | tag))
            if parts:
                yield batch_of(WINDOWS, **{n: np.concatenate(c)
                                           for n, c in zip(WINDOWS.names, zip(*parts))})

    return run


RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                    ("kept_text", pa.string()), ("kept_sha256", pa.string())])


def cut_out(window: int, with_text: bool):
    """Words outside the spans of each document; a span is start * 2^32 + end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, out = batch.to_pydict(), []
            for doc_id, packed, spans in zip(rows["doc_id"], rows["packed"], rows["spans"]):
                words = unpack(packed)
                n, gone = len(words), 0
                if spans:
                    step = np.zeros(n + 1, np.int64)
                    s = np.array(spans, np.int64)
                    np.add.at(step, np.clip(s >> 32, 0, n), 1)
                    np.add.at(step, np.clip(s & 0xFFFFFFFF, 0, n), -1)
                    keep = np.cumsum(step[:n]) == 0
                    gone = n - int(keep.sum())
                    words = [words[i] for i in np.flatnonzero(keep)]
                kept = b" ".join(words)
                out.append((doc_id, n, gone, kept.decode() if with_text else None,
                            hashlib.sha256(kept).hexdigest()))
            if out:
                yield batch_of(RESULT, **dict(zip(RESULT.names, zip(*out))))

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """Each row's words outside windows of ``window`` words that also start earlier.

    Earlier is a smaller id, or the same id and a smaller place. Columns: doc_id,
    n_words, n_removed, kept_text (words joined by a space; null unless
    ``with_text``), kept_sha256. A null text has no words. Rows without an id come
    after all others; rows that share id and text get the same result, as neither
    is earlier. Further columns are ignored.
    """
    if window < 2 or window % 2:
        raise ValueError("the window is twice a whole number of words")
    reach = window - window // 2
    source = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"),
                         F.col(id_col).cast("long").alias("doc_id"),
                         F.col(text_col).cast("string").alias("text"))
    found = source.select("doc", "text").mapInArrow(
        find_anchors(window), "h long, ctx long, doc long, at long")
    repeated = found.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
    seen = stored(found.join(repeated, "h", "left_semi"), "anchors")

    first = seen.groupBy("h", "ctx").agg(F.min(F.struct("doc", "at")).alias("f"),
                                         F.count("*").alias("n"))
    first = stored(first.select("h", "ctx", "n", F.col("f.doc").alias("fdoc"),
                                F.col("f.at").alias("fat")), "contexts")
    place, fplace = F.shiftright("at", 32), F.shiftright("fat", 32)
    later = (F.col("doc") > F.col("fdoc")) | ((F.col("doc") == F.col("fdoc")) & (place > fplace))
    tag = F.col("at").bitwiseAND(0xFFFFFFFF).alias("tag")

    def span(start, end):
        return (F.shiftleft(F.greatest(start, F.lit(0).cast("long")), 32) + end).alias("span")

    whole = (seen.join(first.filter("n > 1").drop("n"), ["h", "ctx"]).filter(later)
             .select("doc", tag, span(place - reach, place + window)))
    edges = first.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
    check = (first.join(edges, "h", "left_semi")
             .select(F.col("fdoc").alias("doc"), F.col("fat").bitwiseAND(0xFFFFFFFF).alias("tag"),
                     fplace.alias("at")).groupBy("doc", "tag").agg(F.collect_list("at").alias("at")))

    texts = source.mapInArrow(pack, "doc long, tag long, doc_id long, packed binary")
    # Rows that share id and text would put the same windows up twice: harmless for a minimum.
    rows = (texts.join(check, ["doc", "tag"]).select("doc", "tag", "packed", "at")
            .mapInArrow(put_up(window), "w1 long, w2 long, doc long, at long"))
    rows = stored(rows, "windows")
    earliest = rows.groupBy("w1", "w2").agg(F.min(F.struct("doc", "at")).alias("f"),
                                            F.count("*").alias("n")).filter("n > 1")
    earliest = earliest.select("w1", "w2", F.col("f.doc").alias("fdoc"),
                               F.col("f.at").alias("fat"))
    single = (rows.join(earliest, ["w1", "w2"]).filter(later)
              .select("doc", tag, span(place, place + window)))
    spans = (whole.unionByName(single).groupBy("doc", "tag")
             .agg(F.collect_set("span").alias("spans")))
    return (texts.join(spans, ["doc", "tag"], "left").select("doc_id", "packed", "spans")
            .mapInArrow(cut_out(window, with_text), "doc_id long, n_words long, n_removed long, "
                        "kept_text string, kept_sha256 string"))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            window: int = WINDOW) -> DataFrame:
    """(length, n_removed): words in repeats at window, 2 * window, ... until none survives."""
    out, length = None, window
    while True:
        row = remove_repeats(docs, id_col, text_col, length, False).agg(
            F.lit(length).alias("length"), F.coalesce(F.sum("n_removed"), F.lit(0))
            .alias("n_removed"))
        row = stored(row, "level")
        out = row if out is None else out.unionByName(row)
        if row.first().n_removed == 0:
            return out
        length *= 2
