"""The network's gradient, its exact scores, and held-out likelihood."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from llm_cases import odd_docs

from opspark.llm import lm
from opspark.llm.lm import (
    FIRST, HIGHEST, SIDE, Network, Shape, Symbols, by_text, chunks, score, shape_for, start_model,
    start_values, train, words_of, words_of_all)

SMALL = Shape(classes=4, members=4, buckets=4, width=3, hidden=5, chunk=64, step=0.3)


def test_gradient_is_the_slope():
    rng = np.random.default_rng(1)
    net = Network(SMALL, start_values(SMALL) * 0.5)
    ctx, target = rng.integers(0, 17, (40, 4)), rng.integers(0, 16, 40)
    _, g = net.forward(ctx, target, grad=True)
    for i in rng.choice(len(net.values), 60, replace=False):
        loss = []
        for d in (1e-2, -1e-2):
            values = net.values.copy()
            values[i] += d
            loss.append(-Network(SMALL, values).forward(ctx, target)[0].mean())
        assert abs((loss[0] - loss[1]) / 2e-2 - g[i]) < 2e-3


def test_probabilities_sum_to_one():
    net = Network(SMALL, start_values(SMALL))
    ctx = np.tile([[1, 2, 3, 16]], (16, 1))
    assert abs(np.exp(net.forward(ctx, np.arange(16))[0]).sum() - 1) < 1e-5


def test_chunks_hold_every_token_with_its_neighbours():
    rng = random.Random(2)
    texts = [" ".join(rng.choices("abcdefg", k=n)) for n in (0, 1, 2, 3, 50, 700, 5, 256, 257, 63)]
    symbols = Symbols([b"a", b"b", b"c"], SMALL)
    got: dict[int, list] = {}
    for ctx, target, own in chunks([None, *texts], symbols, SMALL):
        for c, t, o in zip(ctx.tolist(), target.tolist(), own.tolist()):
            got.setdefault(o, []).append((c, t))
    for number, text in enumerate(texts, 1):
        ids = [16] * SIDE + symbols.of(text).tolist() + [16] * SIDE
        want = [([ids[i - 2], ids[i - 1], ids[i + 1], ids[i + 2]], ids[i])
                for i in range(SIDE, len(ids) - SIDE)]
        assert got.get(number, []) == want


def test_words_of_a_batch_are_those_of_each_text(monkeypatch):
    rng = random.Random(4)
    parts = ["a", "B", "c", "Éa", "ΑΣ", "İ", "ß", "\u4e2d", "\x1c", "\x85", "\xa0", "\u2003", "\x00", " ", "  ", "\n", "\t\x0b\x0c\r"]
    texts = [None, "", " ", " a", "a "] + ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(400)]
    words, own = words_of_all(texts)
    assert [w.encode() for w in words.to_pylist()] == [w for t in texts for w in words_of(t)]
    assert own.tolist() == [i for i, t in enumerate(texts) for _ in words_of(t)]
    symbols = Symbols([b"a", b"b", "éa".encode()], SMALL)
    ids, own, rare = symbols.of_all(texts)
    assert [v.tolist() for v in by_text(ids, own, len(texts))] == [symbols.of(t).tolist() for t in texts]
    names, times = rare.per_text(len(texts))
    assert [Counter(dict(zip(*p))) for p in zip(names.to_pylist(), times.to_pylist())] == [
        Counter(w for w in words_of(t) if w not in symbols.known) for t in texts]
    none, _, rare = symbols.of_all([None, ""])
    assert len(none) == 0 and [len(x) for x in rare.per_text(2)] == [2, 2]
    for limit in (7, 10**6):
        monkeypatch.setattr(lm, "COUNTED", limit)
        got = Counter()
        for b in lm._count(pa.record_batch({"text": texts[i:i + 50]}) for i in range(0, len(texts), 50)):
            assert b.schema == lm.COUNTS
            for w, n in zip(*(c.to_pylist() for c in b.columns)):
                got[w] += n
        assert got == Counter(w for t in texts for w in words_of(t))


def grammar(rng, n):
    """Each word decides the next, most of the time."""
    w = [rng.randrange(8)]
    while len(w) < n:
        w.append((w[-1] * 3 + 1) % 8 if rng.random() < 0.9 else rng.randrange(8))
    return [f"w{i}" for i in w]


def test_held_out_texts_beat_their_shuffles_and_the_frequencies(spark):
    rng = random.Random(5)
    docs = spark.createDataFrame([(i, " ".join(grammar(rng, 200))) for i in range(200)],
                                 "doc_id long, text string").repartition(2)
    model = train(docs, shape=SMALL, rounds=2)
    fresh = [grammar(rng, 100) for _ in range(20)]
    mixed = [rng.sample(w, len(w)) for w in fresh]
    df = spark.createDataFrame([(i, " ".join(w), "x") for i, w in enumerate(fresh + mixed)],
                               "doc_id long, text string, score string")
    got = {r.doc_id: r for r in score(df, model).collect()}
    assert all(got[i].mean_score > got[20 + i].mean_score for i in range(20))
    assert np.mean([got[i].mean_score for i in range(20)]) > -np.log(8) * 0.7
    assert all(abs(r.score / r.n_tokens - r.mean_score) < 1e-9 and r.n_tokens == 100
               for r in got.values())


def test_odd_rows(spark):
    docs = odd_docs(spark)
    model = train(docs, shape=SMALL)
    got = score(docs, model).collect()
    assert len(got) == docs.count()
    assert [(r.score, r.mean_score) for r in got if r.n_tokens == 0][0] == (0.0, None)
    none = docs.limit(0)
    assert score(none, train(none, shape=SMALL)).count() == 0


def test_words_of_one_bucket_are_told_apart(spark):
    one = Shape(classes=2, members=2, buckets=3, width=3, hidden=5)
    texts = ["the " * 9 + "rare", "the rare rare rare", "the the once"]
    model = train(spark.createDataFrame([(i, t) for i, t in enumerate(texts)],
                                        "doc_id long, text string"), shape=one)
    assert model.words == [b"the"]
    bucket = {w: zlib.crc32(w.encode()) % 3 for w in ("rare", "once", "never", *map(str, range(99)))}
    other = next(w for w in bucket if w.isdigit() and bucket[w] == bucket["rare"])
    df = spark.createDataFrame([(0, "the rare"), (1, f"the {other}"), (2, None)],
                               "doc_id long, text string")
    got = {r.doc_id: r for r in score(df, model).collect()}
    assert abs(got[0].score - got[1].score - np.log(4)) < 1e-4  # n(rare) = 4, and 1 for a new word
    total = 4 + (bucket["once"] == bucket["rare"])
    ctx = np.array([[4, 4, 1 + bucket["rare"], 4], [4, 0, 4, 4]])
    plain = Network(one, model.values).forward(ctx, np.array([0, 1 + bucket["rare"]]))[0].sum()
    assert abs(got[0].score - (plain + np.log(4 / (total + 1)))) < 1e-4
    assert got[2].mean_score is None


def test_the_vocabulary_follows_the_corpus(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    docs = spark.createDataFrame([(i, " ".join(rng.choices(words, k=2000))) for i in range(60)],
                                 "doc_id long, text string").repartition(4)
    docs = docs.select("text")
    few, many = start_model(docs.limit(0), None)[0], start_model(docs, None)[0]
    assert few.shape.symbols == 4 and len(few.words) == 0
    assert FIRST == 960 and 960 <= len(many.words) < 3000
    more = start_model(docs.selectExpr("concat_ws(' ', text, text, text, text) text"), None)[0]
    assert len(more.words) > 2900 and more.shape == shape_for(len(more.words))
    assert more.shape.symbols - more.shape.buckets == len(more.words)


def test_the_file_layout_does_not_matter_and_training_goes_on_until_it_is_done(spark, monkeypatch):
    monkeypatch.setattr(lm, "PART", 20_000)  # two networks
    rng = random.Random(6)
    docs = spark.createDataFrame([(i, " ".join(grammar(rng, 200))) for i in range(200)],
                                 "doc_id long, text string")
    few, many = train(docs.repartition(2)), train(docs.repartition(200))
    assert few.rounds == many.rounds > 1 and abs(few.likelihood - many.likelihood) < 1e-4
    assert np.abs(few.values - many.values).max() < 1e-4
    fresh = spark.createDataFrame([(i, " ".join(grammar(rng, 200))) for i in range(20)],
                                  "doc_id long, text string")
    mean = [np.mean([r.mean_score for r in score(fresh, m).collect()]) for m in (few, many)]
    assert abs(mean[0] - mean[1]) < 1e-4 and mean[0] > -np.log(8) * 0.7


def test_scores_equal_a_plain_version(spark):
    """Token by token: the network's log-probability, and a rare word's share of its bucket."""
    rng = random.Random(11)
    words = [f"W{min(int(rng.expovariate(0.15)), 60)}" for _ in range(3000)]
    texts = [" ".join(words[i:i + rng.randrange(1, 90)]) for i in range(0, 2900, 60)] + ["", None, "New words w0"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:-1])], "doc_id long, text string")
    model = train(docs.repartition(3), shape=SMALL, rounds=1)
    counts = Counter(w for t in texts[:-1] if t for w in t.lower().split())
    net, first = Network(SMALL, model.values), SMALL.symbols - SMALL.buckets
    known = {w.decode(): i for i, w in enumerate(model.words)}

    def symbol(w):
        return known.get(w, first + zlib.crc32(w.encode()) % SMALL.buckets)

    totals = Counter()
    for w, n in counts.items():
        if w not in known:
            totals[symbol(w)] += n
    everything = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in score(everything, model).collect()}
    for i, t in enumerate(texts):
        own = t.lower().split() if t else []
        ids = [SMALL.symbols] * SIDE + [symbol(w) for w in own] + [SMALL.symbols] * SIDE
        want = 0.0
        for k, w in enumerate(own):
            ctx = np.array([[ids[k], ids[k + 1], ids[k + 3], ids[k + 4]]])
            want += float(net.forward(ctx, np.array([ids[k + 2]]))[0][0])
            if w not in known:
                want += np.log(counts[w] or 1) - np.log(totals[symbol(w)] + 1)
        assert abs(got[i].score - want) < 1e-3 * max(1, len(own)) and got[i].n_tokens == len(own)


def test_limit_of_logits_is_skipped_only_where_none_reaches_it():
    shape = Shape(5, 4, 3)
    rng = np.random.default_rng(4)
    ctx = rng.integers(0, shape.symbols + 1, (300, 2 * SIDE))
    target = rng.integers(0, shape.symbols, 300)
    some = np.concatenate([target % 4, np.full(50, 17)])  # classes without a target
    for scale, bounded in ((1, True), (60, False)):
        net = Network(shape, start_values(shape) * scale)
        p = net.part
        low, lows = net._bounded()
        assert (low and all(lows)) == bounded
        h = np.tanh(p["embed"][ctx].reshape(300, -1) @ p["w1"] + p["b1"])

        def logs(logits, bounded):
            assert not bounded or logits.max() < HIGHEST
            e = np.exp(np.minimum(logits, HIGHEST).astype(np.float64))
            return np.log(e / e.sum(axis=-1, keepdims=True) + 1e-20)

        first = logs(h @ p["wc"] + p["bc"], low)
        rest = np.stack([logs(h @ p["wm"][c] + p["bm"][c], lows[c]) for c in range(shape.classes)], axis=1)
        plain = (first[:, :, None] + rest).reshape(300, -1)
        got, none = net.forward(ctx, target)
        assert none is None and np.allclose(got, plain[np.arange(300), target], rtol=1e-4, atol=1e-4)
        both, g = net.forward(ctx, target, grad=True)
        assert np.array_equal(got, both) and g.shape == net.values.shape
        few, g = net.forward(ctx[:1].repeat(350, 0), some, grad=True)
        assert np.allclose(few, plain[0, some], rtol=1e-4, atol=1e-4)
        g = net.views(g)
        for c in set(range(shape.classes)) - set((some // shape.members).tolist()):
            assert not g["wm"][c].any() and not g["bm"][c].any()
