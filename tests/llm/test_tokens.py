"""Own byte-pair merging and the sequence files against the tokenizers library."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_cases import odd_docs
from tokenizers import Tokenizer as Library

from opspark.llm.bpe import Tokenizer, decode, encode, round_trip, tokenizer_source
from opspark.llm.token_files import (Chunks, check_sequences, open_sequences, sequence, write_sequences)

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module", params=["odd", "given"])
def docs(request, spark):
    if request.param == "odd":
        return odd_docs(spark)
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def test_ids_and_text_equal_the_library(docs):
    lib = Library.from_file(WORD)
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(r.text or "")
    got = decode(encode(docs, WORD), WORD).collect()
    assert len(got) == sum(map(len, texts.values()))
    want = {i: sorted((lib.encode(t, add_special_tokens=False).ids for t in ts))
            for i, ts in texts.items()}
    found = defaultdict(list)
    for r in got:
        found[r.doc_id].append(list(r.ids))
        assert r.decoded == lib.decode(list(r.ids), skip_special_tokens=False)
    assert {i: sorted(v) for i, v in found.items()} == want
    once = round_trip(docs, WORD).collect()
    assert sorted(map(repr, once)) == sorted(map(repr, got))


def test_stale_entries_are_skipped():
    tok, lib = Tokenizer(tokenizer_source(WORD)), Library.from_file(WORD)
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 7, 40, 300):
        for _ in range(30):
            word = "".join(rng.choice(list("aabntherio"), n))
            assert tok.encode(word).tolist() == lib.encode(word).ids


def test_files_hold_every_document_in_order(docs):
    lib = Library.from_file(BYTE)
    manifest = write_sequences(docs.repartition(3), BYTE, seq_len=64)
    got = check_sequences(manifest).collect()
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0,
                                                 r.text is not None, r.text or ""))
    start, want = 0, []
    for r in rows:
        ids = lib.encode(r.text or "", add_special_tokens=False).ids + [0]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda x: x[1]) == want


def test_words_that_come_back_are_not_encoded_again(monkeypatch):
    """The distinct words of some tens of thousands of texts."""
    chunks = Chunks(tokenizer_source(BYTE))
    sent, whole = [], chunks._whole
    monkeypatch.setattr(chunks, "_whole", lambda t: sent.append(len(t)) or whole(t))
    texts = ["".join(f" {k:x}" for k in range(i, i + 30_000)) for i in range(10**6, 10**6 + 480_000, 30_000)]
    once = [chunks.encode([t]) for t in texts]
    assert sum(sent) == 480_000
    assert [chunks.encode([t]) for t in texts] == once and sum(sent) == 480_000
    assert once[0] == whole(texts[:1])


def test_sequences_are_equal_length_views(spark, docs):
    row = write_sequences(docs.coalesce(1), BYTE, seq_len=32).orderBy("part").first()
    data, _ = open_sequences(row.path)
    n = sum(data.get_batch(b).num_rows for b in range(data.num_record_batches))
    masks = 0
    for k in range(n):
        ids, mask = sequence(data, k)
        assert len(ids) == len(mask) == 32 and not ids.flags.owndata
        masks += int(mask.sum())
        assert mask.all() or k == n - 1
    assert masks == row.tokens


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert encode(none, WORD).count() == 0
    assert check_sequences(write_sequences(none, BYTE)).count() == 0
