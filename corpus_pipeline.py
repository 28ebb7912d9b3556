"""A training-data pipeline over ``documents``.

Rules, near-duplicates, benchmark passages, personal data, tokens. Each stage works
on all that the one before kept, and its result is written as Parquet and read back
before the next one starts, so a lost executor costs one stage's work at most. All
stages but the last return the columns of ``documents``; where a stage changes the
text, n_chars follows. Rows with a null text or too few words go in the first stage;
an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opspark.llm.bpe import round_trip
from opspark.llm.common import stored
from opspark.llm.decontaminate import decontaminate
from opspark.llm.minhash import keep_first
from opspark.llm.pii import sanitise
from opspark.llm.quality_rules import keep_good
from opspark.llm.queries import tokenizer

TOKENIZER = "word_bpe_49k.json"


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines that too many documents of a source share go too."""
    return _counted(keep_good(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id stays."""
    return keep_first(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of ``benchmark``, also with edits, go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, and terms that disclose it, are replaced by their kind."""
    return _counted(sanitise(docs))


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digest of the text that the ids decode to."""
    return round_trip(docs, tokenizer(TOKENIZER)).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii", pii),
    ("bpe_tokens", bpe_tokens),
]

# Edit distances, patterns with positions and byte-pair merges are beyond SQL: the
# tests hold run() against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
