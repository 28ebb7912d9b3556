"""Token alignment of two tokenizers, scored by how often their ids meet in the corpus.

Both tokenizers' tokens tile the same bytes. Where both end a token the text is cut
into groups; an A token and a B token that share bytes are a link. Links are counted
through an inverted index: each id pair posts the documents it occurs in as compressed
bitmaps, one per block of up to ``WIDTH`` documents. Plane 0 is the document bitmap,
plane k > 0 holds bit k - 1 of (links of the pair in the document, less one). A task
flushes its bitmaps whenever enough links are held; the parts of a (block, pair, plane)
are OR-merged, and popcounts then give a pair's documents and links. At last each
posting returns its pair's score to the documents of its block.

No list of a pair is ever gathered: a pair in all documents has one bounded bitmap in
each block. The join of scores with postings moves keys only. Blocks, not pairs, are
what the bitmaps are shuffled by, and a block holds a bounded number of links (or one
document).
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opspark.llm.bpe import byte_letters, tokenizer_source
from opspark.llm.common import grouped, slices, stored, worker_cache

WIDTH = 8192  # documents of a block; a full bitmap has WIDTH / 8 bytes
BLOCK_LINKS = 16_000_000  # a block is closed at so many links
FLUSH = 2_000_000  # links held by a task before its bitmaps are written
MEMO, LONGEST = 120_000, 64  # chunks remembered (two generations), and their greatest length
TOGETHER = 64  # chunks encoded as one text
SPACE = "▁"

# A chunk begins with a blank after something that is not white space. A's pieces never
# cross such a place, and B has no entry that does (checked), so chunks stand alone.
CHUNK = re.compile(r"\s*\S+(?:[^\S\x20]\s*\S+)*(?:[^\S\x20]\s*\Z)?|\s+\Z")


class Aligner:
    """Ids, groups and links of texts under a byte-level BPE (A) and a SentencePiece BPE (B)."""

    def __init__(self, a_source: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are shared with other tasks
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_source)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=b_model)
        byte = {c: i for i, c in enumerate(byte_letters())}
        size = self.a.get_vocab_size(with_added_tokens=True)
        self.a_bytes = [bytes(byte.get(c, 32) for c in self.a.id_to_token(i) or "")
                        for i in range(size)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i)
                        else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.n_b = len(pieces)
        self.blank = self.b.piece_to_id(SPACE)
        self.a_len = np.array(list(map(len, self.a_bytes)), np.int64)
        self.b_len = np.array(list(map(len, self.b_bytes)), np.int64)
        self.shown = [f"{i}{mark}" for n, marks in ((size, ",|"), (self.n_b, ",;"))
                      for i in range(n) for mark in marks]
        self.shown_len = np.array(list(map(len, self.shown)), np.int64)
        self.memo: dict[str, tuple | None] = {}
        self.old: dict[str, tuple | None] = {}
        self.passing: list[str] = []  # chunks too long to be remembered

    def _ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A's and B's ids of the chunks, one after another. Chunks that do not end in white
        space are encoded joined, ``TOGETHER`` at a time, as they would be in a text."""
        texts, at = [], 0
        while at < len(chunks) and not chunks[at][-1].isspace():
            to = at + 1
            while to < min(len(chunks), at + TOGETHER) and not chunks[to][-1].isspace():
                to += 1
            texts.append("".join(chunks[at:to]))
            at = to
        texts += chunks[at:]
        a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        # B puts a blank before what it is given: the one a text begins with.
        b = [ids or [self.blank] for ids in self.b.encode([t[1:] for t in texts], num_threads=1)]
        return np.array(list(chain.from_iterable(a))), np.array(list(chain.from_iterable(b)))

    def _aligned(self, chunks: list[str]) -> list[tuple | None]:
        """(A tokens, B tokens, groups, links, groups as text) of chunks; None where bytes differ.

        Chunks that end in white space have to be last.
        """
        ia, ib = self._ids(chunks)
        whole = "".join(chunks).encode()
        if b"".join(map(self.a_bytes.__getitem__, ia.tolist())) != whole \
                or b"".join(map(self.b_bytes.__getitem__, ib.tolist())) != whole:
            half = len(chunks) // 2
            return self._aligned(chunks[:half]) + self._aligned(chunks[half:]) if half else [None]
        a_end, b_end = self.a_len[ia].cumsum(), self.b_len[ib].cumsum()
        first = np.searchsorted(b_end, a_end - self.a_len[ia], "right")
        count = np.searchsorted(b_end, a_end, "left") - first + 1
        done = np.concatenate([[0], count.cumsum()])
        met = np.repeat(first - done[:-1], count) + np.arange(done[-1])
        links = (np.repeat(ia, count) * self.n_b + ib[met]).astype("<i8").tobytes()
        cut = np.intersect1d(a_end, b_end, assume_unique=True)
        # The groups as text: A's ids of a group, a bar, B's ids, a semicolon.
        code = np.concatenate([2 * ia + np.isin(a_end, cut, assume_unique=True),
                               2 * (len(self.a_len) + ib) + np.isin(b_end, cut, assume_unique=True)])
        group = np.concatenate([2 * np.searchsorted(cut, a_end), 2 * np.searchsorted(cut, b_end) + 1])
        code = code[np.argsort(group, kind="stable")]
        text = "".join(map(self.shown.__getitem__, code.tolist()))
        # Where each chunk ends: in the text's bytes, tokens, groups, links, shown characters.
        end = np.cumsum([len(c.encode()) for c in chunks])
        a_to = np.searchsorted(a_end, end, "right")
        b_to = np.searchsorted(b_end, end, "right")
        g_to = np.searchsorted(cut, end, "right")
        shown = np.concatenate([[0], self.shown_len[code].cumsum()])[a_to + b_to]
        out, was = [], (0, 0, 0, 0, 0)
        for now in zip(a_to.tolist(), b_to.tolist(), g_to.tolist(), (8 * done[a_to]).tolist(),
                       shown.tolist()):
            out.append((now[0] - was[0], now[1] - was[1], now[2] - was[2], links[was[3]:now[3]],
                        text[was[4]:now[4]]))
            was = now
        return out

    def align(self, texts: list[str | None]) -> Iterator[tuple | None]:
        """As ``_aligned``, for whole texts; None for those without tokens."""
        for chunk in self.passing:
            self.memo.pop(chunk, None)
        if len(self.memo) >= MEMO:
            self.memo, self.old = {}, self.memo
        memo, old = self.memo, self.old
        cuts = [CHUNK.findall(" " + t) if t else [] for t in texts]
        fresh = []
        for chunk in set().union(*cuts) - memo.keys():
            if chunk in old:
                memo[chunk] = old[chunk]
            else:
                fresh.append(chunk)
        self.passing = [chunk for chunk in fresh if len(chunk) > LONGEST]
        fresh.sort(key=lambda c: c[-1].isspace())
        for at in range(0, len(fresh), 20_000):
            part = fresh[at:at + 20_000]
            memo.update(zip(part, self._aligned(part)))
        for chunks in cuts:
            parts = list(map(memo.__getitem__, chunks))
            if not parts or None in parts:
                yield None
                continue
            a, b, g, links, text = zip(*parts)
            yield sum(a), sum(b), sum(g), b"".join(links), "".join(text)[:-1]


def pack(keys: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(groups, bitmaps) of ascending distinct group * WIDTH + place.

    Up to WIDTH / 16 places are a list of uint16, more are a bitmap of WIDTH / 8 bytes
    (which only a list of WIDTH / 16 places could equal in length: that is a bitmap too).
    """
    group, place = np.divmod(keys, WIDTH)
    at = np.flatnonzero(np.diff(group, prepend=group[:1] - 1))
    size = np.diff(np.append(at, len(keys)))
    low = place.astype("<u2").tobytes()
    dense = size >= WIDTH // 16
    if not dense.any():
        offsets = np.append(at, len(keys)).astype(np.int32) * 2
        return group[at], pa.Array.from_buffers(
            pa.binary(), len(at), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(low)])
    values = []
    for i, n, full in zip(at.tolist(), size.tolist(), dense.tolist()):
        if full:
            bits = np.zeros(WIDTH, np.uint8)
            bits[place[i:i + n]] = 1
            values.append(np.packbits(bits, bitorder="little").tobytes())
        else:
            values.append(low[2 * i:2 * (i + n)])
    return group[at], pa.array(values, pa.binary())


def unpack(bitmaps: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of every document in the bitmaps, by row."""
    rows, places = [], []
    sizes = np.array([len(v) for v in bitmaps.to_pylist()], np.int64)
    dense = np.flatnonzero(sizes == WIDTH // 8)
    thin = np.flatnonzero(sizes < WIDTH // 8)
    if len(thin):
        joined = b"".join(bitmaps.take(pa.array(thin)).to_pylist())
        places.append(np.frombuffer(joined, "<u2").astype(np.int64))
        rows.append(np.repeat(thin, sizes[thin] // 2))
    if len(dense):
        raw = np.frombuffer(b"".join(bitmaps.take(pa.array(dense)).to_pylist()), np.uint8)
        row, place = np.nonzero(np.unpackbits(raw.reshape(len(dense), -1), axis=1,
                                              bitorder="little"))
        rows.append(dense[row])
        places.append(place)
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    row, place = np.concatenate(rows), np.concatenate(places)
    order = np.argsort(row, kind="stable")
    return row[order], place[order]


DOC = pa.struct([("place", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()),
                 ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                 ("groups", pa.string())])
POSTED = pa.schema([("block", pa.int64()), ("pair", pa.int64()), ("plane", pa.int32()),
                    ("bits", pa.binary()), ("doc", DOC)])
POSTED_SQL = ("block long, pair long, plane int, bits binary, doc struct<place: int, "
              "doc_id: long, n_a: long, n_b: long, n_groups: long, n_links: long, groups: string>")


def _rows(schema: pa.Schema, n: int, **columns) -> pa.RecordBatch:
    def column(f: pa.Field) -> pa.Array:
        c = columns.get(f.name)
        if c is None:
            return pa.nulls(n, f.type)
        return c if isinstance(c, pa.Array) else pa.array(c, f.type)

    return pa.RecordBatch.from_arrays([column(f) for f in schema], schema=schema)


class Poster:
    """Numbers documents and turns their links into bitmaps, a bounded number at a time."""

    def __init__(self, first: int):
        self.block, self.place, self.in_block = first, 0, 0
        self.links, self.sizes, self.places, self.held = [], [], [], 0

    def add(self, links: bytes) -> tuple[int, int]:
        """(block, place) of the document that has these links."""
        spot = self.block, self.place
        if links:
            self.links.append(links)
            self.sizes.append(len(links) // 8)
            self.places.append(self.place)
            self.held += self.sizes[-1]
            self.in_block += self.sizes[-1]
        self.place += 1
        return spot

    @property
    def full(self) -> bool:
        return self.place == WIDTH or self.in_block >= BLOCK_LINKS

    def next_block(self) -> None:
        self.block, self.place, self.in_block = self.block + 1, 0, 0

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        keys = np.frombuffer(b"".join(self.links), "<i8") * WIDTH
        keys += np.repeat(np.array(self.places, np.int64), self.sizes)
        self.links, self.sizes, self.places, self.held = [], [], [], 0
        keys.sort()
        at = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
        more = np.diff(np.append(at, len(keys))) - 1
        keys = keys[at]
        for plane in range(1 + int(more.max()).bit_length()):
            part = keys[(more >> (plane - 1)) & 1 > 0] if plane else keys
            pairs, bits = pack(part)
            for i in range(0, len(pairs), 10_000):
                n = min(10_000, len(pairs) - i)
                yield _rows(POSTED, n, block=np.full(n, self.block), pair=pairs[i:i + n],
                            plane=np.full(n, plane, np.int32), bits=bits.slice(i, n))


def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """OR of the bitmaps of each (block, pair, plane), from rows sorted by those."""
    schema = pa.schema([f for f in POSTED if f.name != "doc"])
    for t in grouped(batches, "block"):
        t = t.combine_chunks()
        pair, plane = t["pair"].to_numpy(), t["plane"].to_numpy()
        run = np.cumsum((np.diff(pair, prepend=pair[:1] - 1) != 0)
                        | (np.diff(plane, prepend=plane[:1]) != 0)) - 1
        lead = np.flatnonzero(np.diff(run, prepend=-1))
        edges = [*range(0, len(lead), 10_000), len(lead)]
        for i, j in zip(edges, edges[1:]):
            a, b = int(lead[i]), int(lead[j]) if j < len(lead) else len(pair)
            row, place = unpack(t["bits"].combine_chunks().slice(a, b - a))
            runs, bits = pack(np.unique((run[a:b][row]) * WIDTH + place))
            at = lead[runs]
            yield _rows(schema, len(at), block=np.full(len(at), t["block"][0].as_py()),
                        pair=pair[at], plane=plane[at], bits=bits)


SCORED = pa.schema([*DOC, ("n_best", pa.int64()), ("count_sum", pa.int64())]).remove(0)


def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each block with the scores its postings return to them.

    Rows are sorted by (block, pair, plane), nulls first: the documents, then for each
    pair its score (plane -1) and its bitmaps.
    """
    for t in grouped(batches, "block"):
        t = t.combine_chunks()
        docs = t["pair"].null_count
        t, found = t.slice(docs), t["doc"].combine_chunks().slice(0, docs)
        total, best = np.zeros(WIDTH, np.int64), np.zeros(WIDTH, np.int64)
        plane = t["plane"].to_numpy()
        is_score = plane < 0
        owner = np.cumsum(is_score) - 1
        links = t["links"].filter(pa.array(is_score)).to_numpy()
        top = t["best"].filter(pa.array(is_score)).to_numpy().astype(np.int64)
        spots = np.flatnonzero(~is_score)
        bits = t["bits"].combine_chunks()
        for at in range(0, len(spots), 10_000):
            part = spots[at:at + 10_000]
            row, place = unpack(bits.take(pa.array(part)))
            row = part[row]
            times = np.left_shift(1, np.maximum(plane[row] - 1, 0).astype(np.int64))
            np.add.at(total, place, times * links[owner[row]])
            np.add.at(best, place, times * top[owner[row]])
        columns = {f.name: found.field(f.name) for f in DOC}
        place = columns.pop("place").to_numpy()
        columns |= {"n_best": best[place], "count_sum": total[place]}
        whole = pa.table([pa.array(columns[n]) for n in SCORED.names], schema=SCORED)
        yield from whole.to_batches(max_chunksize=1000)


def _sources(a_path: str, b_path: str) -> tuple[str, bytes]:
    """The two files, if they are of the kinds that the chunks are cut for."""
    a, b = tokenizer_source(a_path), open(b_path, "rb").read()
    from sentencepiece import SentencePieceProcessor

    parts, model = json.loads(a), SentencePieceProcessor(model_proto=b)
    split = parts["pre_tokenizer"] or {}
    if parts["normalizer"] or split.get("type") != "ByteLevel" or not split.get("use_regex") \
            or split.get("add_prefix_space"):
        raise ValueError("A must be a byte-level BPE without normalizer and prefix")
    if any(re.search(f"[^{SPACE}]{SPACE}", model.id_to_piece(i))
           for i in range(model.get_piece_size())) or model.encode("a") != model.encode("a ")[:-1] \
            or not model.id_to_piece(model.encode("a"))[0].startswith(SPACE):
        raise ValueError("B must put a blank before texts and have no entry with one inside")
    return a, b


def post(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id",
         text_col: str = "text", keep_groups: bool = True) -> DataFrame:
    """Documents and bitmaps of their id pairs, stored: block, pair, plane, bits, doc.

    ``doc.groups`` is the text of the groups, or its SHA-256 without ``keep_groups``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_sources(a_path, b_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = worker_cache("aligner", lambda: Aligner(*shared.value), hash(shared.value))
        poster = Poster(TaskContext.get().partitionId() << 32)
        for batch in slices(batches, 256):
            out: list[list] = [[] for _ in range(1 + len(DOC))]
            for doc_id, found in zip(batch.column(0).to_pylist(),
                                     made.align(batch.column(1).to_pylist())):
                n_a, n_b, n_groups, links, groups = found or (0, 0, 0, b"", "")
                if groups and not keep_groups:
                    groups = hashlib.sha256(groups.encode()).hexdigest()
                block, place = poster.add(links)
                for column, value in zip(out, (block, place, doc_id, n_a, n_b, n_groups,
                                               len(links) // 8, groups)):
                    column.append(value)
                if poster.held >= FLUSH or poster.full:
                    yield from poster.flush()
                    if poster.full:
                        poster.next_block()
            doc = pa.StructArray.from_arrays(
                [pa.array(c, f.type) for c, f in zip(out[1:], DOC)], fields=list(DOC))
            yield _rows(POSTED, len(doc), block=out[0], doc=doc)
        yield from poster.flush()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    return stored(rows.mapInArrow(run, POSTED_SQL), "posted")


def merged_postings(posted: DataFrame) -> DataFrame:
    """One bitmap per (block, pair, plane), stored."""
    order = ["block", "pair", "plane"]
    return stored(posted.filter("pair IS NOT NULL").select(*order, "bits").repartition("block")
                  .sortWithinPartitions(*order)
                  .mapInArrow(merge, "block long, pair long, plane int, bits binary"), "postings")


def pair_counts(postings: DataFrame) -> DataFrame:
    """pair, docs, links: popcounts, summed map-side first."""
    ones = F.when(F.length("bits") == WIDTH // 8, F.bitmap_count("bits")).otherwise(
        F.expr("length(bits) div 2"))
    times = F.expr("shiftleft(1L, greatest(plane - 1, 0))")
    return (postings.select("pair", "plane", ones.alias("ones"), (ones * times).alias("links"))
            .groupBy("pair").agg(
                F.sum(F.when(F.col("plane") == 0, F.col("ones")).otherwise(0)).alias("docs"),
                F.sum("links").alias("links")))


def pair_table(docs: DataFrame, a_path: str, b_path: str, **options) -> DataFrame:
    """a_id, b_id, docs (that hold the pair linked), links (in all of them)."""
    n_b = _size(b_path)
    counts = pair_counts(merged_postings(post(docs, a_path, b_path, keep_groups=False, **options)))
    return counts.select(F.expr(f"pair div {n_b}").alias("a_id"),
                         F.expr(f"pair % {n_b}").alias("b_id"), "docs", "links")


def _size(b_path: str) -> int:
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=b_path).get_piece_size()


def align(docs: DataFrame, a_path: str, b_path: str, **options) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups, n_best and count_sum for every row.

    A gets a blank and the text, B the text (it adds the blank). ``n_best`` counts the
    links whose pair has the most links of all pairs of its B id (ties included),
    ``count_sum`` adds the pairs' links over the document's links. A null or empty text,
    and one whose tokens do not spell it, has no tokens: zeros and ''. Rows stand for
    themselves: repeated rows and rows without an id are counted each. No rows give no
    rows. Further columns are ignored.
    """
    posted = post(docs, a_path, b_path, **options)
    postings = merged_postings(posted)
    counts = stored(pair_counts(postings).withColumn("b", F.expr(f"pair % {_size(b_path)}")),
                    "pairs")
    top = counts.groupBy("b").agg(F.max("links").alias("most"))
    scores = counts.join(top, "b").select("pair", "links", (F.col("links") == F.col("most"))
                                          .alias("best"))
    returned = postings.filter("plane = 0").select("block", "pair").join(scores, "pair")
    rows = (posted.filter("pair IS NULL").select("block", "doc")
            .unionByName(returned.withColumn("plane", F.lit(-1)), allowMissingColumns=True)
            .unionByName(postings, allowMissingColumns=True)
            .select("block", "pair", "plane", "bits", "links", "best", "doc"))
    return (rows.repartition("block").sortWithinPartitions("block", "pair", "plane")
            .mapInArrow(score, "doc_id long, n_a long, n_b long, n_groups long, n_links long, "
                               "groups string, n_best long, count_sum long"))
