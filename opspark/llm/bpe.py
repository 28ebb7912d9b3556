"""Byte-pair encoding and decoding of whole texts, from a tokenizer file's tables.

Pieces of a text are independent, so each distinct piece is merged once per worker
(a bounded memo). Merging keeps the piece as a doubly linked list of symbols and
the possible merges in a priority queue by rank, then place. A queue entry whose
symbols have changed since is stale and is skipped. Decoding looks the ids up and
concatenates the vocabulary strings, joined as a file without a decoder asks.

Supported files: BPE models with normalizers NFC, white space to one blank and
Lowercase, and pre-tokenizers Split (matches kept) and ByteLevel; others raise.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opspark.llm.common import worker_cache

MEMO = 120_000
# The characters with the Unicode property White_Space.
SPACES = ("\\t\\n\\x0b\\x0c\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029"
          "\\u202f\\u205f\\u3000")
# Fixed value: the pieces of a word; letters alone are one piece, and none crosses white space.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# What str.split() splits at beyond the property White_Space.
SEPARATORS = "\x1c\x1d\x1e\x1f"


def byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself if visible, else the next free code point."""
    visible = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return [chr(b if b in visible else next(hidden)) for b in range(256)]


def _listed(part: dict | None, kind: str) -> list[dict]:
    if part is None:
        return []
    return part[kind] if part["type"] == "Sequence" else [part]


class Memo(dict):
    """Results by word, in two generations: what is used again survives, the rest goes."""

    def __init__(self, make, limit: int = MEMO, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest, self.old = make, limit, longest, {}

    def __missing__(self, word: str) -> bytes:
        value = self.old.get(word)
        if value is None:
            value = self.make(word)
            if len(word) > self.longest:
                return value
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[word] = value
        return value


class Tokenizer:
    """Tables of one file; ``encode`` gives ids, ``decode`` text."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("unk_token") or model.get("byte_fallback") \
                or model.get("dropout") or model.get("continuing_subword_prefix"):
            raise ValueError("only plain BPE models are supported")
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {self.vocab[a] << 32 | self.vocab[b]: r for r, (a, b) in enumerate(pairs)}
        self.made = [self.vocab[a + b] for a, b in pairs]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]
               for t in spec["added_tokens"]):
            raise ValueError("only literal added tokens are supported")
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") \
            if self.special else None
        self.steps = [n["type"] for n in _listed(spec["normalizer"], "normalizers")]
        for n in _listed(spec["normalizer"], "normalizers"):
            if n["type"] not in ("NFC", "Lowercase", "Replace") or (
                    n["type"] == "Replace" and (n["pattern"], n["content"]) != ({"Regex": r"\s+"}, " ")):
                raise ValueError(f"unsupported normalizer {n}")
        split, level = _listed(spec["pre_tokenizer"], "pretokenizers")
        if (split["type"], level["type"]) != ("Split", "ByteLevel") or not split["invert"] \
                or split["behavior"] != "Removed" or level["use_regex"] or level["add_prefix_space"]:
            raise ValueError("unsupported pre-tokenizer")
        if split["pattern"]["Regex"] != PIECES:
            raise ValueError("unsupported pre-tokenizer pattern")
        self.pieces = regex.compile(PIECES.replace("\\s", SPACES))
        self.words = regex.compile(f"[^{SPACES}]+")
        self.letters = byte_letters()
        self.inner = [self.vocab.get(c) for c in self.letters]
        self.final = [self.vocab.get(c + self.suffix) for c in self.letters]
        self.memo, self.piece_memo = Memo(self.word), Memo(self.piece)
        self.strings = {i: s for s, i in chain(self.vocab.items(), self.special.items())}
        if spec["decoder"] is not None:
            raise ValueError("unsupported decoder")

    def merge(self, piece: str) -> list[int]:
        """Ids of one piece. A queue entry is rank * 2^shift + place, so ranks go first."""
        raw = piece.encode("utf-8", "replace")
        ids = [self.inner[b] for b in raw]
        ids[-1] = self.final[raw[-1]]
        if None in ids:
            ids = [i for i in ids if i is not None]
        n, rank_of = len(ids), self.ranks.get
        shift = n.bit_length()
        low = (1 << shift) - 1
        queue = []
        for i in range(n - 1):
            rank = rank_of(ids[i] << 32 | ids[i + 1])
            if rank is not None:
                queue.append(rank << shift | i)
        if not queue:
            return ids
        heapq.heapify(queue)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        ids.append(-1)  # after the last symbol: no pair with it has a rank
        while queue:
            entry = heapq.heappop(queue)
            i = entry & low
            j = right[i]
            rank = entry >> shift
            if ids[i] < 0 or j >= n or rank_of(ids[i] << 32 | ids[j]) != rank:
                continue  # stale: one of the two symbols is no longer what it was
            ids[i] = new = self.made[rank]
            ids[j] = -1
            right[i] = after = right[j]
            if after < n:
                left[after] = i
                rank = rank_of(new << 32 | ids[after])
                if rank is not None:
                    heapq.heappush(queue, rank << shift | i)
            before = left[i]
            if before >= 0:
                rank = rank_of(ids[before] << 32 | new)
                if rank is not None:
                    heapq.heappush(queue, rank << shift | before)
        return [i for i in ids if i >= 0]

    def normalize(self, text: str) -> str:
        for step in self.steps:
            if step == "NFC":
                text = text if text.isascii() else unicodedata.normalize("NFC", text)
            elif step == "Lowercase":  # character by character, so no special form at the end of a word
                text = text.replace("Σ", "σ").lower()
        return text

    def piece(self, piece: str) -> bytes:
        ids = self.merge(piece)
        return struct.pack(f"<{len(ids)}i", *ids)

    def word(self, word: str) -> bytes:
        """Little-endian ids of a run without white space."""
        word = self.normalize(word)
        if word.isalpha():  # letters alone are one piece
            return self.piece_memo[word]
        return b"".join(map(self.piece_memo.__getitem__, self.pieces.findall(word)))

    def encode(self, text: str) -> np.ndarray:
        """Neither a piece nor a normal form crosses white space, so words are independent."""
        out = []
        for part in (self.cut.split(text) if self.cut else [text]):
            if part in self.special:
                out.append(struct.pack("<i", self.special[part]))
            elif not any(map(part.__contains__, SEPARATORS)):
                out.extend(map(self.memo.__getitem__, part.split()))
            else:  # characters that str.split() takes for white space, but the file does not
                out.extend(map(self.memo.__getitem__, self.words.findall(part)))
        return np.frombuffer(b"".join(out), "<i4")

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.strings.__getitem__, ids))


def tokenizer_source(path: str, limit_mb: int = 64) -> str:
    """A tokenizer file's text, of checked size, as it is sent to the workers."""
    with open(path, encoding="utf-8") as f:
        source = f.read(limit_mb * 2**20 + 1)
    if len(source) > limit_mb * 2**20:
        raise ValueError(f"{path} is over {limit_mb} MB")
    return source


def _loaded(source) -> Tokenizer:
    text = source.value
    return worker_cache(f"bpe-{hashlib.sha1(text.encode()).hexdigest()}", lambda: Tokenizer(text))


IDS, DECODED = "doc_id long, ids array<int>", "doc_id long, ids array<int>, decoded string"


def _with_ids(tok: Tokenizer, part: pa.RecordBatch) -> list[pa.Array]:
    ids = [tok.encode(t) if t else np.empty(0, np.int32) for t in part.column(1).to_pylist()]
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return [part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))]


def _with_text(tok: Tokenizer, columns: list[pa.Array]) -> list[pa.Array]:
    texts = [tok.decode(ids.values.to_numpy().tolist()) if ids.is_valid else None
             for ids in columns[1]]
    return [*columns, pa.array(texts, pa.string())]


def _map(df: DataFrame, tokenizer_path: str, steps: list, schema: str) -> DataFrame:
    """Apply ``steps`` to a few documents at a time, whose ids alone are held."""
    source = df.sparkSession.sparkContext.broadcast(tokenizer_source(tokenizer_path))
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _loaded(source)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                for step in steps:
                    part = step(tok, part)
                yield pa.RecordBatch.from_arrays(part, names)

    return df.mapInArrow(run, schema)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id and ids array<int> of every row's whole text (null: empty, no ids).

    Rows are independent: repeated rows and ids give repeated results; a null id
    stays null. Further columns are ignored.
    """
    return _map(_texts(docs, id_col, text_col), tokenizer_path, [_with_ids], IDS)


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with the decoded text beside; null ids give null."""
    return _map(encoded.select("doc_id", "ids"), tokenizer_path,
                [lambda tok, part: _with_text(tok, part.columns)], DECODED)


def round_trip(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``decode(encode(docs))`` in one pass: the ids need not leave the worker in between."""
    return _map(_texts(docs, id_col, text_col), tokenizer_path, [_with_ids, _with_text], DECODED)
