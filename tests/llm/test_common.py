"""What the operators' Python workers hold at a time."""

import pyarrow as pa

from opspark.llm import common
from opspark.llm.common import ARROW_BYTES, READ_ROWS, small_batches, worker_cache


def test_batches_of_long_texts_are_small(spark):
    keys = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch",
            "spark.sql.parquet.columnarReaderBatchSize"]
    old = [spark.conf.get(k) for k in keys]
    try:
        for k in keys:
            spark.conf.unset(k)
        small_batches(spark)
        docs = spark.range(0, 900, 1, 1).selectExpr("id", "repeat('word ', 2000) text")
        sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows], "size": [b.nbytes]})
                                                 for b in batches), "n long, size long").collect()
        assert sum(r.n for r in sizes) == 900
        assert max(r.size for r in sizes) < 2 * ARROW_BYTES  # 9 MB in one batch before
        assert int(spark.conf.get(keys[2])) == READ_ROWS
        spark.conf.set(keys[1], "1000")
        small_batches(spark)
        assert spark.conf.get(keys[1]) == "1000"  # a smaller limit stays
    finally:
        for k, v in zip(keys, old):
            spark.conf.set(k, v.rstrip("bB"))


def test_a_worker_lets_an_operators_memory_go(monkeypatch):
    done = []
    monkeypatch.setattr(common.gc, "collect", lambda: done.append(1))
    assert worker_cache("a", lambda: 1) == worker_cache("a", lambda: 2) == 1 and len(done) == 1
    assert worker_cache("b", lambda: 2) == 2 and len(done) == 2
