"""Keys: folds by hash, and sortable row keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from opspark.functions.columns import as_col

__all__ = ["hash_percent", "row_key"]


def hash_percent(keys: Sequence[str], seed: int = 42, buckets: int = 100) -> Column:
    """A bucket in 0..buckets-1 from md5 of the joined key.

    md5 rather than the engine's own hash, so that any engine gives the same fold.
    """
    text = F.concat_ws(":", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(buckets))


def row_key(prefix: Column | str, ident: Column | str, width: int = 6) -> Column:
    """Letters of the prefix in upper case, ``#``, and the id padded with zeros.

    An id longer than ``width`` keeps all its digits (padding alone would cut it).
    """
    text = as_col(ident).cast("string")
    return F.concat(
        F.upper(F.regexp_replace(as_col(prefix), "[^A-Za-z]", "")), F.lit("#"),
        F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text))
