import sys
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

ODD_TEXTS = [
    None, "", " ", "\n\n", "a", "a b c d", "A b\tC  d e f\x1cg", "x" * 3000, "w " * 2500,
    "İstanbul ΣΊΣΥΦΟΣ ſtraße Kelvin é é ﬁ Ⅷ ½ 日本語 🙂🙂", "it's we'll I'D <|endoftext|> x",
    "<|startoftext|><|endoftext|>", "  lead and trail  ", "one\r\ntwo\x0bthree\x0cfour\x85five",
    "12 345 6'7 8.9", "'s 't", " line para", "\x00 nul", "same text twice", "same text twice",
]


def odd_docs(spark):
    """Null, empty, long, tied and repeated rows, with columns whose names clash."""
    rows = [(i, t, "n", i, "t") for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id here", None, None, None), (3, "\n\n", "n", 3, "t"), (3, "other", "n", 3, "t")]
    return spark.createDataFrame(
        rows, "doc_id long, text string, n_words string, start long, spans string")


def clashing(docs):
    """``docs`` with every name that an operator might use inside."""
    names = ["_rank", "_host", "_lines", "_uid", "_row", "leaks", "host", "lines", "uid", "any", "a.b",
             "kept", "component_id", "block", "t`k"]
    return docs.select("*", *[F.col("doc_id").cast("string").alias(n) for n in names])
