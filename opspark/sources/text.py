"""Schema on read for text and JSON columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opspark.functions.columns import coerce_value

# The fields of an access-log line and the pattern that splits one.
ACCESS_LOG_FIELDS = ("host", "identity", "user", "time", "request", "status", "size")
ACCESS_LOG_PATTERN = (
    r'^([^ ]*) ([^ ]*) ([^ ]*) (-|\[[^\]]*\]) ([^ "]*|"[^"]*") (-|[0-9]*) (-|[0-9]*)$')


def regex_table(df: DataFrame, col: str, pattern: str, names: Sequence[str],
                keep: Sequence[str] = ()) -> DataFrame:
    """One string column per capture group; null in all of them where nothing matches."""
    hit = F.col(col).rlike(pattern)
    return df.select(*keep, *[
        F.when(hit, F.regexp_extract(col, pattern, i)).alias(n)
        for i, n in enumerate(names, start=1)])


def json_table(df: DataFrame, col: str, schema: T.StructType | str,
               keep: Sequence[str] = ()) -> DataFrame:
    """A JSON message column (text or bytes) parsed with a schema and flattened."""
    parsed = df.select(*keep, F.from_json(F.col(col).cast("string"), schema).alias("_d"))
    return parsed.select(*keep, "_d.*")


def coerce(df: DataFrame, spec: Mapping[str, str], digits: int = 4) -> DataFrame:
    """The named columns as the given types; a value that does not fit becomes null."""
    return df.withColumns({c: coerce_value(c, kind, digits) for c, kind in spec.items()})
