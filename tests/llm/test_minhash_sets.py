"""Which texts of a corpus are fetched for the full sets."""

from pyspark.sql import functions as F

from opspark.llm.minhash import may_hold


def test_wanted_texts_stay_and_few_others(spark):
    source = spark.range(20_000).select(
        F.when(F.col("id") > 0, F.col("id") - 10_000).alias("doc_id"),
        F.col("id").cast("string").alias("text"))
    wanted = source.filter("doc_id % 50 = 0").select("doc_id")
    got = {r.doc_id: r.text for r in may_hold(source, wanted).collect()}
    assert all(got[i] == str(i + 10_000) for i in range(-9950, 10_000, 50))
    assert len(got) < 3000
    assert may_hold(source, wanted.limit(0)).count() == 0
