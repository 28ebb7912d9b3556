"""Document scores by masked pseudo-likelihood.

A small network predicts each token from the two before and the two after it. The
sum of the log-probabilities of all tokens, each with itself masked, is the
document's pseudo-log-likelihood.

Vocabulary: every word of at least sqrt(tokens) / ``LEAST`` occurrences in the whole
corpus (and at least the ``FIRST`` most frequent) has a symbol of its own, so the
network grows with the corpus. Every other word falls into a bucket by hash, which
the network predicts; within it, the word has its share of the bucket's tokens,
p(word | bucket) = n(word) / (n(bucket) + 1). The 1 stands for words that the corpus
does not hold. The counts are a stored table that Spark joins with the documents'
words. The output is two-level (a class, then a member of it; as many classes as
members), which costs two short softmaxes in place of one over all symbols.

Training: the rows, as symbols, are dealt by a hash of id and text into parts of at
least ``PART`` tokens (and eight tokens for each parameter), and each part into
``ROUNDS`` equal shares, so the model does not depend on the files. The network starts
at the frequencies of the words. In a round each part passes over one share by
stochastic gradient steps in numpy (Adagrad); the parts' parameters and step sums are
averaged by token count in Spark, block by block, and only the average reaches the
driver. ``ROUNDS`` rounds pass over all rows. Rounds go on from the average at least
so long, and until the mean log-likelihood of the tokens, each measured before its
step, has twice in a row risen by less than ``TOLERANCE`` of its size (or has so from one
pass over all rows to the next). Nothing is
sampled: all rows are counted, trained on and scored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opspark.llm.common import (batch_of, remove, slices, small_batches, stored, stored_at,
                                worker_cache)
from opspark.session import scratch_path

SIDE = 2  # words on each side
LEAST, FIRST = 8, 960
PART, ROUNDS, TOLERANCE = 4_000_000, 4, 0.01
HIGHEST = 60.0  # of a logit: its exponential is a float32, so none needs to be subtracted
BLOCK = 8192  # parameters in one row


@dataclass(frozen=True)
class Shape:
    """Sizes of the network, and its step."""

    classes: int = 32
    members: int = 32
    buckets: int = 64
    width: int = 8
    hidden: int = 16
    step: float = 0.15
    chunk: int = 8192

    @property
    def symbols(self) -> int:
        return self.classes * self.members

    def sizes(self) -> dict[str, tuple[int, ...]]:
        return {"embed": (self.symbols + 1, self.width), "w1": (2 * SIDE * self.width, self.hidden),
                "b1": (self.hidden,), "wc": (self.hidden, self.classes), "bc": (self.classes,),
                "wm": (self.classes, self.hidden, self.members), "bm": (self.classes, self.members)}


def shape_for(words: int) -> Shape:
    """The shape with a symbol for each of ``words`` words and a bucket for 15 of them."""
    side = max(2, math.ceil(math.sqrt(words + max(1, words // 15))))
    return Shape(side, side, side * side - words)


def start_values(shape: Shape, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    parts = []
    for name, size in shape.sizes().items():
        scale = 0.0 if name[0] == "b" else (0.5 if name == "embed" else size[-2] ** -0.5)
        parts.append((rng.standard_normal(size) * scale).ravel())
    return np.concatenate(parts).astype(np.float32)


class Network:
    """Parameters as views of one vector; log-probabilities and gradients of chunks."""

    def __init__(self, shape: Shape, values: np.ndarray):
        self.shape, self.values = shape, values.astype(np.float32)
        self.part = self.views(self.values)
        self._ones = np.ones(max(shape.chunk * 5, shape.classes, shape.members), np.float32)

    def views(self, values: np.ndarray) -> dict[str, np.ndarray]:
        parts, at = {}, 0
        for name, size in self.shape.sizes().items():
            n = int(np.prod(size))
            parts[name] = values[at:at + n].reshape(size)
            at += n
        return parts

    def _bounded(self) -> tuple[bool, list[bool]]:
        """Whether the logits of the classes, and of each class' members, stay below ``HIGHEST``
        whatever the context: the hidden values are between -1 and 1."""
        p, most = self.part, HIGHEST - 1
        return (bool((np.abs(p["wc"]).sum(axis=0) + p["bc"]).max() < most),
                ((np.abs(p["wm"]).sum(axis=1) + p["bm"]).max(axis=1) < most).tolist())

    def _powers(self, logits: np.ndarray, bias: np.ndarray, bounded: bool):
        """(exponentials of the logits, in place; what makes each row's sum one). Sums over
        short rows are products with ones."""
        logits += bias
        if not bounded:
            np.minimum(logits, HIGHEST, out=logits)
        np.exp(logits, out=logits)
        return logits, 1 / (logits @ self._ones[:logits.shape[1]])

    def forward(self, ctx: np.ndarray, target: np.ndarray, grad: bool = False):
        """(log-probability of each target, gradient of the mean loss or None)."""
        p, n, size, classes = self.part, len(target), self.shape.members, self.shape.classes
        cls = target // size
        # Few classes: numbers of 16 bits, which numpy sorts by their digits.
        order = np.argsort(cls.astype(np.uint16) if classes < 2**16 else cls, kind="stable")
        ctx, target, cls = ctx.take(order, axis=0), target[order], cls[order]
        x = p["embed"].take(ctx, axis=0).reshape(n, -1)
        h = x @ p["w1"]
        h += p["b1"]
        np.tanh(h, out=h)
        rows = np.arange(n)
        low, lows = self._bounded()
        out, scale = self._powers(h @ p["wc"], p["bc"], low)
        at = rows * classes + cls
        logp = out.take(at) * scale
        edges = np.searchsorted(cls, np.arange(classes + 1)).tolist()
        if grad:
            flat = np.empty_like(self.values)
            g = self.views(flat)
            g["wm"][:] = 0
            g["bm"][:] = 0
            out *= scale[:, None]
            out.reshape(-1)[at] -= 1
            np.matmul(h.T, out, out=g["wc"])
            np.matmul(self._ones[:n], out, out=g["bc"])
            dh = out @ p["wc"].T
        # Where a row's target stands among the rows of its class.
        at = (rows - np.take(edges, cls)) * size + (target - cls * size)
        mine = np.empty_like(logp)
        for c in range(classes):
            a, b = edges[c], edges[c + 1]
            if a == b:
                continue
            here, own = h[a:b], at[a:b]
            sub, scale = self._powers(here @ p["wm"][c], p["bm"][c], lows[c])
            np.multiply(sub.take(own), scale, out=mine[a:b])
            if grad:
                sub *= scale[:, None]
                sub.reshape(-1)[own] -= 1
                np.matmul(here.T, sub, out=g["wm"][c])
                np.matmul(self._ones[:b - a], sub, out=g["bm"][c])
                dh[a:b] += sub @ p["wm"][c].T
        back = np.empty_like(logp)
        back[order] = np.log(logp + 1e-20) + np.log(mine + 1e-20)
        if not grad:
            return back, None
        dz = dh * (1 - h * h)
        np.matmul(x.T, dz, out=g["w1"])
        g["b1"][:] = dz.sum(axis=0)
        dx = np.ascontiguousarray((dz @ p["w1"].T).reshape(-1, self.shape.width).T, np.float64)
        seen = ctx.ravel()
        for k in range(self.shape.width):
            g["embed"][:, k] = np.bincount(seen, dx[k], self.shape.symbols + 1)
        flat /= n
        return back, flat


def words_of(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").split() if text else []


def words_of_all(texts: list[str | None]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts as ``words_of`` has them, and the number of each word's text."""
    lists = pc.ascii_split_whitespace(pa.array([t.lower() if t else "" for t in texts], pa.large_string()))
    words, own = lists.flatten(), pc.list_parent_indices(lists)
    some = pc.not_equal(words, "")  # blanks at a text's ends leave an empty one
    return words.filter(some), own.filter(some).to_numpy().astype(np.int64)


def as_bytes(words: pa.Array) -> pa.Array:
    return words.cast(pa.large_binary()).cast(pa.binary())


class Symbols(dict):
    """Word -> symbol; words beyond the vocabulary by hash. A bounded memo."""

    def __init__(self, words: list[bytes], shape: Shape, limit: int = 300_000):
        super().__init__()
        self.known = {w: i for i, w in enumerate(words)}
        self.table = pa.array([w.decode() for w in words], pa.large_string())
        self.buckets, self.first, self.limit = shape.buckets, shape.symbols - shape.buckets, limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self.known.get(word)
        if value is None:
            value = self.first + zlib.crc32(word) % self.buckets
        self[word] = value
        return value

    def of(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))

    def of_all(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, Rare]:
        """The symbols of all texts' words, the number of each word's text, and the words that
        have no symbol of their own. A batch's words are looked up at once."""
        words, own = words_of_all(texts)
        at = pc.index_in(words, value_set=self.table)
        other = pc.is_null(at).to_numpy(zero_copy_only=False)
        ids = pc.fill_null(at, 0).to_numpy().astype(np.int32)
        coded = words.filter(pa.array(other)).dictionary_encode()
        names = as_bytes(coded.dictionary)
        forms = names.to_numpy(zero_copy_only=False).tolist()  # to_pylist() takes ten times as long
        bucket = np.fromiter(map(zlib.crc32, forms), np.int64, len(forms)) % self.buckets
        codes = coded.indices.to_numpy()
        ids[other] = self.first + bucket[codes]
        return ids, own, Rare(names, codes, own[other])


@dataclass
class Rare:
    """Words without a symbol: their distinct forms, and form and text of each."""

    names: pa.Array
    codes: np.ndarray
    own: np.ndarray

    def per_text(self, n: int) -> tuple[pa.Array, pa.Array]:
        """Lists of the distinct words of each of ``n`` texts, and how often each stands there."""
        size = max(1, len(self.names))
        both, times = np.unique(self.own * size + self.codes, return_counts=True)
        ends = pa.array(np.searchsorted(both // size, np.arange(n + 1)), pa.int32())
        return (pa.ListArray.from_arrays(ends, self.names.take(pa.array(both % size))),
                pa.ListArray.from_arrays(ends, pa.array(times, pa.int32())))


def by_text(ids: np.ndarray, own: np.ndarray, n: int) -> list[np.ndarray]:
    """The symbols of each of ``n`` texts."""
    return np.split(ids, np.searchsorted(own, np.arange(1, n)))


class Given:
    """Texts that are arrays of symbols already."""

    @staticmethod
    def of(ids: np.ndarray) -> np.ndarray:
        return ids


def chunks(texts: Iterable, symbols: Symbols | Ids | type[Given], shape: Shape):
    """(contexts, targets, number of the text of each) in chunks of bounded size."""
    pad, held, owner, size = shape.symbols, [], [], 0
    gap = np.full(SIDE, pad, np.int32)

    def cut():
        ids = np.concatenate([*held, gap])
        own = np.concatenate([*owner, np.zeros(SIDE, np.int64)])
        target = ids[SIDE:-SIDE]
        here = np.flatnonzero(target != pad)
        offsets = [k for k in range(2 * SIDE + 1) if k != SIDE]
        return np.stack([ids[here + k] for k in offsets], axis=1), target[here], own[here + SIDE]

    for number, text in enumerate(texts):
        ids = symbols.of(text)
        for at in range(0, len(ids), shape.chunk * 4):
            # The neighbours of a long text's cut stand in its pads' place.
            part = ids[at:at + shape.chunk * 4]
            if at or at + len(part) < len(ids):
                if size:
                    yield cut()
                    held, owner, size = [], [], 0
                wide = np.concatenate([gap, ids, gap])[at:at + len(part) + 2 * SIDE]
                offsets = [k for k in range(2 * SIDE + 1) if k != SIDE]
                ctx = np.stack([wide[k:k + len(part)] for k in offsets], axis=1)
                yield ctx, part, np.full(len(part), number)
                continue
            held += [gap, part]
            owner += [np.zeros(SIDE, np.int64), np.full(len(part), number)]
            size += len(part)
        if size >= shape.chunk:
            yield cut()
            held, owner, size = [], [], 0
    if size:
        yield cut()


COUNTS = pa.schema([("word", pa.binary()), ("n", pa.int64())])


COUNTED = 2_000_000  # words that a task counts at once, a longer one as several


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words, size = [], 0

    def out() -> pa.RecordBatch:
        seen = pc.value_counts(pa.chunked_array(words))
        return pa.RecordBatch.from_arrays([as_bytes(seen.field("values")), seen.field("counts")], schema=COUNTS)

    for batch in slices(batches):
        found, _ = words_of_all(batch.column(0).to_pylist())
        words.append(found)
        size += max(len(found), found.nbytes // 16)
        if size >= COUNTED:
            yield out()
            words, size = [], 0
    if size:
        yield out()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) of every lower-case word of ``texts`` (text), stored."""
    counts = texts.mapInArrow(_count, "word binary, n long").groupBy("word").agg(
        F.sum("n").alias("n"))
    return stored(counts, "words")


def vocabulary(counts: DataFrame, size: int | None, tokens: int) -> tuple[list[bytes], list[int]]:
    """The ``size`` most frequent words, ties by word, and their counts. Without a size as the
    module states."""
    if size is None:
        least = max(2, math.ceil(math.sqrt(tokens) / LEAST))
        size = max(FIRST, counts.filter(F.col("n") >= least).count())
    top = counts.orderBy(F.desc("n"), "word").limit(size).collect()
    return [bytes(r.word) for r in top], [r.n for r in top]


def frequency_biases(model: Model, times: list[int]) -> None:
    """Set the output biases to the logarithms of the symbols' shares."""
    shape, part = model.shape, Network(model.shape, model.values)
    n = np.full(shape.symbols, 0.5)
    n[:len(times)] += times
    n[shape.symbols - shape.buckets:] += model.totals
    n = n.reshape(shape.classes, shape.members)
    part.part["bc"][:] = np.log(n.sum(axis=1) / n.sum())
    part.part["bm"][:] = np.log(n / n.sum(axis=1, keepdims=True))
    model.values = part.values


@dataclass
class Model:
    """A network, its words, the tokens of each bucket, and the other words' counts."""

    shape: Shape
    words: list[bytes]
    values: np.ndarray
    totals: np.ndarray
    counts: DataFrame | None = field(default=None, compare=False)  # (word, n); stays on the driver
    rounds: int = 0
    likelihood: float | None = None  # mean per token, of the network's symbols, in the last round

    def key(self) -> str:
        return hashlib.sha1(self.values.tobytes() + self.totals.tobytes()
                            + b" ".join(self.words)).hexdigest()

    def __getstate__(self) -> dict:
        return vars(self) | {"counts": None}


def start_model(texts: DataFrame, shape: Shape | None) -> tuple[Model, int]:
    """A model with its vocabulary and counts, the network at its start values; all tokens."""
    counts = word_counts(texts)
    tokens = counts.agg(F.sum("n")).first()[0] or 0
    words, times = vocabulary(counts, shape and shape.symbols - shape.buckets, tokens)
    shape = shape or shape_for(len(words))
    known = stored(counts.sparkSession.createDataFrame([(w,) for w in words], "word binary"), "known")
    rare = counts.join(known, "word", "left_anti")
    bucket = F.pmod(F.crc32("word"), F.lit(shape.buckets))
    totals = np.zeros(shape.buckets)
    for r in rare.groupBy(bucket.alias("b")).agg(F.sum("n").alias("n")).collect():
        totals[r.b] = r.n
    # A word of one occurrence has the logarithm 0, as one that is not in the table.
    many = stored(rare.filter("n > 1"), "rare")
    model = Model(shape, words, start_values(shape), totals, many)
    if tokens:
        frequency_biases(model, times)
    return model, tokens


class Ids:
    """Texts that are symbols already, as bytes."""

    def __init__(self, shape: Shape):
        self.kind = np.dtype("<u2" if shape.symbols < 2**16 else "<u4")

    def of(self, ids: bytes) -> np.ndarray:
        return np.frombuffer(ids, self.kind).astype(np.int32)


IDS = pa.schema([("part", pa.int32()), ("h", pa.int64()), ("ids", pa.binary())])
WEIGHTS = pa.schema([("block", pa.int64()), ("tokens", pa.int64()), ("logp", pa.float64()),
                     ("v", pa.binary())])
MEANS = pa.schema([("block", pa.int64()), ("v", pa.binary())])


def _weights(tokens: int, logp: float, both: np.ndarray) -> pa.RecordBatch:
    v = [both[at:at + BLOCK].tobytes() for at in range(0, len(both), BLOCK)]
    n = len(v)
    return batch_of(WEIGHTS, block=range(n), tokens=[tokens] * n, logp=[logp] * n, v=v)


def _mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The mean of each block's rows (sorted by block), by token count."""
    block, total, weight = None, 0.0, 0

    def out():
        return batch_of(MEANS, block=[block], v=[(total / weight).astype(np.float32).tobytes()])

    for batch in slices(batches, 16):
        for b, tokens, v in zip(*(c.to_pylist() for c in batch.columns)):
            if b != block:
                if weight:
                    yield out()
                block, total, weight = b, 0.0, 0
            total = total + np.frombuffer(v, np.float32).astype(np.float64) * tokens
            weight += tokens
    if weight:
        yield out()


def deal(docs: DataFrame, model: Model, parts: int, text_col: str, id_col: str) -> DataFrame:
    """(part, ids, share) of every text, stored by share, each part in one file in the order of h."""
    source = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = source.value
        symbols, kind = Symbols(model.words, model.shape), Ids(model.shape).kind
        for batch in slices(batches):
            if batch.num_rows:
                found, own, _ = symbols.of_all(batch.column(2).to_pylist())
                ids = [v.astype(kind).tobytes() for v in by_text(found, own, batch.num_rows)]
                yield batch_of(IDS, part=batch.column(0), h=batch.column(1), ids=ids)

    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    h = F.xxhash64(text, *[F.col(c).cast("string") for c in (id_col,) if c in docs.columns])
    rows = (docs.select(F.pmod(h, F.lit(parts)).cast("int").alias("part"), h.alias("h"),
                        text.alias("text"))
            .mapInArrow(run, "part int, h long, ids binary").repartitionById(parts, "part")
            .withColumn("share", F.pmod(F.xxhash64("h"), F.lit(ROUNDS)).cast("int"))
            .sortWithinPartitions("share", "part", "h", "ids").select("part", "ids", "share"))
    path = scratch_path(spark, "dealt")
    rows.write.partitionBy("share").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def done(seen: list[float]) -> bool:
    """Whether the likelihoods of the rounds have stopped rising: in the last two rounds, or, as
    rounds of few tokens go up and down, from one pass over all rows to the next."""
    def small(a: float, b: float) -> bool:
        return b - a < TOLERANCE * abs(b)

    last, before = seen[-ROUNDS:], seen[-2 * ROUNDS:-ROUNDS]
    return all(small(a, b) for a, b in zip(seen[-3:], seen[-2:])) or (
        len(before) == ROUNDS and small(sum(before), sum(last)))


def train(docs: DataFrame, text_col: str = "text", shape: Shape | None = None,
          rounds: int | None = None, id_col: str = "doc_id") -> Model:
    """A model of all texts of ``docs``; without any token it keeps its start values.

    Without a ``shape`` its size follows from the corpus; without ``rounds`` their
    number follows from the likelihood. ``id_col``, if ``docs`` has it, sends copies
    of a text to different parts.
    """
    spark = docs.sparkSession
    small_batches(spark)
    model, tokens = start_model(docs.select(F.col(text_col).cast("string").alias("text")), shape)
    if not tokens:
        return model
    parts = math.ceil(tokens / max(PART, 8 * len(model.values)))
    dealt = deal(docs, model, parts, text_col, id_col)
    square, seen = np.full(len(model.values), 1e-4, np.float32), []
    while rounds is None or model.rounds < rounds:
        source = spark.sparkContext.broadcast((model, square))

        def run(batches: Iterator[pa.RecordBatch], source=source) -> Iterator[pa.RecordBatch]:
            model, first = source.value
            ids, total, tokens, logp = Ids(model.shape), 0.0, 0, 0.0

            def learn(texts: Iterator[bytes]):
                for ctx, target, _ in chunks(texts, ids, model.shape):
                    got, g = net.forward(ctx, target, grad=True)
                    np.add(square, g * g, out=square)
                    net.values -= model.shape.step * g / np.sqrt(square)
                    yield len(target), float(got.sum())

            rows = ((p, v) for batch in slices(batches)
                    for p, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            for _, group in groupby(rows, lambda r: r[0]):
                net, square = Network(model.shape, model.values.copy()), first.copy()
                steps = list(learn(v for _, v in group))
                n = sum(s[0] for s in steps)
                total = total + np.concatenate([net.values, square]).astype(np.float64) * n
                tokens, logp = tokens + n, logp + sum(s[1] for s in steps)
            if tokens:  # the parts of a task are one row a block
                yield _weights(tokens, logp, (total / tokens).astype(np.float32))

        share = dealt.filter(F.col("share") == model.rounds % ROUNDS).select("part", "ids")
        trained, path = stored_at(
            share.mapInArrow(run, "block long, tokens long, logp double, v binary"), "parts")
        now = trained.filter("block = 0").agg(F.sum("logp") / F.sum("tokens")).first()[0]
        if now is not None:  # a share may be empty
            mean = (trained.repartition("block").sortWithinPartitions("block", "tokens", "v")
                    .select("block", "tokens", "v").mapInArrow(_mean, "block long, v binary"))
            both = np.concatenate([np.frombuffer(r.v, np.float32) for r in sorted(
                mean.collect(), key=lambda r: r.block)])
            model, square = replace(model, values=both[:len(square)]), both[len(square):]
            seen.append(now)
        model = replace(model, rounds=model.rounds + 1, likelihood=seen[-1] if seen else None)
        source.destroy()
        remove(spark, path)
        if rounds is None and model.rounds >= ROUNDS and done(seen):
            break
    return model


SCORES = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                    ("score", pa.float64()), ("words", pa.list_(pa.binary())),
                    ("times", pa.list_(pa.int32()))])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, score (sum of log-probabilities) and mean_score of each row.

    A null or wordless text has no tokens, score 0 and a null mean. Repeated rows
    score alike. Further columns are ignored.
    """
    source = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = source.value
        net, symbols = worker_cache("lm", lambda: (
            Network(model.shape, model.values), Symbols(model.words, model.shape)), model.key())
        # The bucket's part of log p(word | bucket); log n(word) comes from the table.
        within = np.concatenate([np.zeros(symbols.first), -np.log(model.totals + 1)])
        for batch in slices(batches, 256):
            n = batch.num_rows
            if not n:
                continue
            total, count = np.zeros(n), np.zeros(n, np.int64)
            found, texts, rare = symbols.of_all(batch.column(2).to_pylist())
            for ctx, target, own in chunks(by_text(found, texts, n), Given, model.shape):
                logp, _ = net.forward(ctx, target)
                total += np.bincount(own, logp + within[target], n)
                count += np.bincount(own, minlength=n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(count), pa.array(total), *rare.per_text(n)],
                schema=SCORES)

    rows = stored(docs.select(F.monotonically_increasing_id().alias("uid"),
                              F.col(id_col).cast("long").alias("doc_id"),
                              F.col(text_col).cast("string").alias("text"))
                  .mapInArrow(run, "uid long, doc_id long, n_tokens long, score double, "
                              "words array<binary>, times array<int>"), "scored")
    held = rows.select("uid", F.explode(F.arrays_zip("words", "times")).alias("x")).select(
        "uid", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
    more = (held.join(model.counts, "word").groupBy("uid")
            .agg(F.sum(F.col("times") * F.log("n")).alias("more")))
    total = F.col("score") + F.coalesce("more", F.lit(0.0))
    return rows.select("uid", "doc_id", "n_tokens", "score").join(more, "uid", "left").select(
        "doc_id", "n_tokens", total.alias("score"),
        F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias("mean_score"))
