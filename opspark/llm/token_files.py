"""Token ids in Arrow files of equal-length sequences.

Documents are range-partitioned by id, and each partition becomes one Arrow IPC
file. Its record batches hold fixed-size lists: ``input_ids`` (all documents' ids
one after another, cut every ``seq_len``) and ``mask`` (false only on the padding
of the last sequence). Nothing is compressed, so a reader maps the file and takes
any sequence without copying or scanning. A second Arrow file beside it lists each
document's first position and length.

A task writes under a fresh name and returns one manifest row. The manifest is a
Spark table, so after a lost executor only files of tasks that finished count.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opspark.llm.bpe import SPACES, tokenizer_source
from opspark.llm.common import batch_of, stored, worker_cache
from opspark.llm.files import file_system
from opspark.session import scratch_path

SEQ_LEN, ROWS, MEMO = 2048, 128, 500_000


class Chunks:
    """Ids of texts through the tokenizers library, each distinct chunk encoded once.

    A chunk is a word with at most one blank before it, or a run of white space; a
    run of letters before a punctuation mark is a chunk too. The library's own pieces
    never cross such a border, so chunk by chunk it gives the same ids as the whole
    text. Texts with a special token go to it whole. The memo has two generations:
    chunks that are used again survive, the others go.
    """

    CUT = re.compile(f"\\x20?[A-Za-zÀ-ÖØ-öø-ÿ]+(?=[,.;:!?|*#$%&)]|[{SPACES}]|\\Z)"
                     f"|\\x20?[^{SPACES}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")

    def __init__(self, source: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are shared with other tasks
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(source)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        size = self.tok.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 65536 else "<u4")
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes()
                for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text."""
        if len(self.memo) >= MEMO:
            self.memo, self.old = {}, self.memo
        memo, old = self.memo, self.old
        cuts = [None if any(s in t for s in self.special) else self.CUT.findall(t) for t in texts]
        # Not ``- memo.keys()``, which goes through the whole memo.
        unseen = set().union(*filter(None, cuts)).difference(memo)
        fresh = []
        for chunk in unseen:
            if chunk in old:
                memo[chunk] = old[chunk]
            else:
                fresh.append(chunk)
        if fresh:
            memo.update(zip(fresh, self._whole(fresh)))
        return [self._whole([t])[0] if c is None else b"".join(map(memo.__getitem__, c))
                for t, c in zip(texts, cuts)]


MANIFEST = pa.schema([("part", pa.int64()), ("path", pa.string()), ("docs", pa.int64()),
                      ("tokens", pa.int64())])
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class SequenceWriter:
    """Appends documents to one file pair; holds at most one record batch of ids."""

    def __init__(self, path: str, dtype: np.dtype, seq_len: int):
        self.fs, name = file_system(path)
        self.fs.create_dir(name.rpartition("/")[0], recursive=True)
        self.schema = pa.schema([
            ("input_ids", pa.list_(pa.field("id", pa.from_numpy_dtype(dtype), False), seq_len)),
            ("mask", pa.list_(pa.field("used", pa.bool_(), False), seq_len))])
        self.sink = self.fs.open_output_stream(name)
        self.side = self.fs.open_output_stream(name + ".index")
        self.data = pa.ipc.new_file(self.sink, self.schema)
        self.index = pa.ipc.new_file(self.side, INDEX)
        self.dtype, self.seq_len, self.full = dtype, seq_len, seq_len * ROWS
        self.held, self.size, self.tokens, self.docs = [], 0, 0, 0

    def _batch(self, ids: np.ndarray) -> None:
        used, rows = len(ids), -(-len(ids) // self.seq_len)
        ids = np.concatenate([ids, np.zeros(rows * self.seq_len - used, self.dtype)])
        mask = np.arange(len(ids)) < used
        self.data.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(pa.array(v), type=f.type)
             for v, f in zip((ids, mask), self.schema)], schema=self.schema))

    def add(self, rows: list[tuple[int, np.ndarray]]) -> None:
        starts = []
        for _, ids in rows:
            starts.append(self.tokens)
            self.held.append(ids)
            self.size += len(ids)
            self.tokens += len(ids)
        self.docs += len(rows)
        self.index.write_batch(batch_of(INDEX, doc_id=[r[0] for r in rows], start=starts,
                                        n_tokens=[len(r[1]) for r in rows]))
        while self.size >= self.full:
            ids = np.concatenate(self.held)
            self._batch(ids[:self.full])
            self.held, self.size = [ids[self.full:]], len(ids) - self.full

    def close(self) -> None:
        if self.size:
            self._batch(np.concatenate(self.held))
        for x in (self.data, self.index, self.sink, self.side):
            x.close()


def write_sequences(docs: DataFrame, tokenizer_path: str, folder: str | None = None,
                    id_col: str = "doc_id", text_col: str = "text", seq_len: int = SEQ_LEN,
                    end_id: int = 0) -> DataFrame:
    """Write the files in ascending order of id; returns the manifest.

    Manifest: part, path, docs, tokens, base (ids in all files before). Rows
    without an id come last; rows of one id are ordered by text. A null text is
    empty: it has the end id alone. No rows, no files. Further columns are ignored.
    """
    spark = docs.sparkSession
    source = spark.sparkContext.broadcast(tokenizer_source(tokenizer_path))
    folder = folder or scratch_path(spark, "sequences")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = worker_cache(f"chunks-{hash(source.value)}", lambda: Chunks(source.value))
        end = np.array([end_id], chunks.dtype).tobytes()
        part, out = TaskContext.get().partitionId(), None
        name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.arrow"
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                found = chunks.encode([t or "" for t in rows.column(1).to_pylist()])
                out = out or SequenceWriter(name, chunks.dtype, seq_len)
                out.add([(i, np.frombuffer(b + end, chunks.dtype))
                         for i, b in zip(rows.column(0).to_pylist(), found)])
        if out:
            out.close()
            yield batch_of(MANIFEST, part=[part], path=[name], docs=[out.docs],
                           tokens=[out.tokens])

    order = [F.col("doc_id").asc_nulls_last()]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    manifest = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
                      .mapInArrow(run, "part long, path string, docs long, tokens long"),
                      "manifest")
    # One row per file: a small window.
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def open_sequences(path: str):
    """(ids file, index file), memory-mapped where the store is local."""
    fsys, name = file_system(path)
    if fsys.type_name == "local":
        return (pa.ipc.open_file(pa.memory_map(name)),
                pa.ipc.open_file(pa.memory_map(name + ".index")))
    return (pa.ipc.open_file(fsys.open_input_file(name)),
            pa.ipc.open_file(fsys.open_input_file(name + ".index")))


def sequence(reader, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, mask) of the k-th sequence of a file; the ids are a view of it."""
    batch = reader.get_batch(k // ROWS)
    ids, mask = batch.column(0)[k % ROWS].values, batch.column(1)[k % ROWS].values
    return ids.to_numpy(), mask.to_numpy(zero_copy_only=False)


def documents_of(path: str) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, start in the file, ids) of each document, one record batch at a time."""
    data, index = open_sequences(path)
    number, ids, first = -1, np.empty(0), 0
    for b in range(index.num_record_batches):
        rows = index.get_batch(b).to_pydict()
        for doc_id, start, n in zip(*rows.values()):
            parts, at = [], start
            while at < start + n:
                if number < 0 or at >= first + len(ids):
                    first, number = (first + len(ids) if number >= 0 else 0), number + 1
                    ids = data.get_batch(number).column(0).flatten().to_numpy()
                    continue
                parts.append(ids[at - first:min(start + n - first, len(ids))])
                at += len(parts[-1])
            yield doc_id, start, parts[0] if len(parts) == 1 else np.concatenate(parts)


READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                  ("ids_crc32", pa.int64())])


def check_sequences(manifest: DataFrame) -> DataFrame:
    """Each document as its file has it: doc_id, start over all files, n_tokens, ids_crc32."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = batch.to_pydict(), []
            for path, base in zip(rows["path"], rows["base"]):
                for doc_id, start, ids in documents_of(path):
                    out.append((doc_id, base + start, len(ids), zlib.crc32(ids.astype("<u4"))))
                    if len(out) == 4096:
                        yield batch_of(READ, **dict(zip(READ.names, zip(*out))))
                        out = []
            if out:
                yield batch_of(READ, **dict(zip(READ.names, zip(*out))))

    # One task per file: by number, as adaptive execution would join such small rows.
    return manifest.select("path", "base").repartition(max(1, manifest.count())).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")

