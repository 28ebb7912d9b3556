"""Alignment of two tokenizers against a plain loop over whole texts."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from llm_cases import odd_docs
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from opspark.llm import alignment
from opspark.llm.alignment import align, pack, pair_table, unpack
from opspark.llm.bpe import byte_letters
from opspark.llm.queries import op11_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain_links(lib, sp, text):
    """(A ids, B ids, groups, links) of one text, byte by byte."""
    if not text:
        return None
    byte = {c: i for i, c in enumerate(byte_letters())}
    a, b = lib.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
    a_bytes = [bytes(byte[c] for c in lib.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i)
               else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
    whole = (" " + text).encode()
    if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return None
    a_at = [k for k, t in enumerate(a_bytes) for _ in t]
    b_at = [k for k, t in enumerate(b_bytes) for _ in t]
    links = sorted({(x, y) for x, y in zip(a_at, b_at)})
    groups, x, y = [], 0, 0
    for i in range(len(whole)):
        last = i + 1 == len(whole)
        if last or (a_at[i] != a_at[i + 1] and b_at[i] != b_at[i + 1]):
            groups.append((a[x:a_at[i] + 1], b[y:b_at[i] + 1]))
            x, y = a_at[i] + 1, b_at[i] + 1
    return a, b, groups, [(a[i], b[j]) for i, j in links]


def plain(rows):
    lib, sp = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    lib.encode_special_tokens = True
    found = [(i, plain_links(lib, sp, t)) for i, t in rows]
    count, most, docs = Counter(), defaultdict(int), Counter()
    for _, f in found:
        count.update(f[3] if f else ())
        docs.update(set(f[3]) if f else ())
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for i, f in found:
        if f is None:
            out.append((i, 0, 0, 0, 0, "", 0, 0))
            continue
        a, b, groups, links = f
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, len(a), len(b), len(groups), len(links), text,
                    sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links)))
    return out, {p: (docs[p], n) for p, n in count.items()}


@pytest.fixture(scope="module", params=["odd", "given"])
def docs(request, spark):
    if request.param == "odd":
        extra = spark.createDataFrame(
            [(100 + i, t, "n", i, "t") for i, t in enumerate(
                ["a\n  b  c \n", "▁ x", "tab\t\t x  y \xa0 z", "   ", "end  ", "it's  we'll",
                 "<s> <0x41> </s>", "日本 語🙂 🙂", "x" * 300 + " y", "1234 5678", "\x1c a\x1f b"])],
            "doc_id long, text string, n_words string, start long, spans string")
        return odd_docs(spark).unionByName(extra)
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.mark.parametrize("small", [False, True])
def test_rows_equal_the_plain_loop(docs, monkeypatch, small):
    if small:  # many blocks, several flushes a block, bitmaps longer than lists
        for name, value in (("WIDTH", 64), ("FLUSH", 500), ("BLOCK_LINKS", 9000), ("MEMO", 50)):
            monkeypatch.setattr(alignment, name, value)
    want, _ = plain([(r.doc_id, r.text) for r in docs.collect()])
    got = align(docs.repartition(3), A, B).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_pair_table_counts_documents_and_links(docs):
    _, want = plain([(r.doc_id, r.text) for r in docs.collect()])
    got = pair_table(docs, A, B).collect()
    assert {(r.a_id, r.b_id): (r.docs, r.links) for r in got} == want
    assert len(got) == len(want)


def test_query_digests_the_groups(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want, _ = plain([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: r for r in op11_alignment(spark, folder).collect()}
    assert len(got) == len(want)
    for i, a, b, g, n, text, best, total in want:
        assert tuple(got[i][c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best",
                                         "count_sum")) == (a, b, g, n, best, total)
        assert got[i].groups_sha256 == (hashlib.sha256(text.encode()).hexdigest() if text else "")


def test_bitmaps_come_back():
    rng = np.random.default_rng(1)
    keys = np.unique(np.concatenate([
        rng.integers(0, alignment.WIDTH, 300), alignment.WIDTH + rng.integers(0, 512, 4000),
        3 * alignment.WIDTH + rng.integers(0, alignment.WIDTH, 7000), [9 * alignment.WIDTH]]))
    groups, bits = pack(keys)
    row, place = unpack(bits)
    assert groups.tolist() == [0, 1, 3, 9] and (groups[row] * alignment.WIDTH + place == keys).all()
    assert max(len(b) for b in bits.to_pylist()) == alignment.WIDTH // 8
    assert len(unpack(pa.array([], pa.binary()))[0]) == 0


def test_empty_table(spark):
    assert align(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0
