"""URL filtering by host and path rules, through an equi-join on short hashes.

A rule names a host and a path. It fits the host and all its subdomains, where the
URL's path starts with the rule's. Each URL is expanded into expressions: every suffix
of its host's labels with every prefix of its path that ends in a slash (and none), as
deep as any rule goes. A rule stands under the one expression made of its host and its
path up to the last slash. Both sides carry the SHA-256 of the expression; its first
four bytes are the join key. A hit counts when the full digests agree and the URL's
path goes on as the rule's does. The longest fitting rule decides.

Equal (id, URL) rows are judged once, and all expressions of a row stay in its
partition. Rules are broadcast only where their measured bytes are below a bound;
beyond it the join shuffles, and expressions that very many URLs share (a top-level
domain) meet their rules without being brought together.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opspark.llm.common import stored
from opspark.operators.joins import skew_join
from opspark.operators.scan import hot_keys

# Rules of up to SMALL bytes are broadcast; expressions of over HOT_ROWS URLs are hot.
SMALL, HOT_ROWS = 8_000_000, 1_000_000
PREFIX = 8  # hexadecimal digits of the digest that the join is on
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What is between the first ``://`` and a slash, ``?`` or ``#``, with A-Z lower-cased."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _depth(path: Column) -> Column:
    return F.size(F.split(path, "/")) - 1


def _upto(path: Column, slashes: Column) -> Column:
    """``path`` up to and with so many slashes."""
    parts = F.slice(F.split(path, "/"), F.lit(1), slashes)
    return F.when(slashes > 0, F.concat(F.array_join(parts, "/"), F.lit("/"))).otherwise("")


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """(verdict, host and path in one) pairs as a rule table: host, path, verdict."""
    rows = [(r.partition("/")[0], "".join(r.partition("/")[1:]), v) for v, r in rules]
    return spark.createDataFrame(rows, "host string, path string, verdict string")


def _keyed(rules: DataFrame) -> DataFrame:
    """Rules under their expression's digest; of rules for one place a block wins."""
    clean = rules.select(
        F.translate(F.col("host"), UPPER, LOWER).alias("r_host"),
        F.coalesce("path", F.lit("")).alias("r_path"), F.col("verdict").alias("r_verdict")).filter(
        "r_host <> '' AND r_verdict IN ('allow', 'block') AND (r_path = '' OR r_path LIKE '/%')")
    one = clean.groupBy("r_host", "r_path").agg(F.max("r_verdict").alias("r_verdict"))
    place = F.concat("r_host", _upto(F.col("r_path"), _depth(F.col("r_path"))))
    return (one.withColumn("r_digest", F.sha2(place, 256))
            .withColumn("prefix", F.substring("r_digest", 1, PREFIX)))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          default: str = "allow") -> DataFrame:
    """page_id, url, host, path, rule and verdict for every row of ``pages``.

    ``rules`` has host, path (null or empty: the whole host) and verdict (allow or
    block); rules without a host, with another verdict, or with a path that does not
    begin with a slash are ignored, repeated ones count once, and of two verdicts for
    one place block holds. Of several fitting rules the longest (host and path) wins,
    then the one with the longer host. A URL that no rule fits has a null rule and the
    verdict ``default``; a null URL, or one without ``://``, has an empty host and path,
    which no rule fits. Rows stand for themselves: repeated rows and null ids are judged
    each. Without rules all rows get the default. Further columns are ignored.
    """
    keyed = stored(_keyed(rules), "rules")
    known = keyed.agg(
        F.count("*"), F.sum(F.octet_length(F.concat("r_host", "r_path")) + 128),
        F.max(F.size(F.split("r_host", r"\."))), F.max(_depth(F.col("r_path")))).first()
    labels, depth = known[2] or 0, known[3] or 0
    rows = (pages.select(F.col(f"`{id_col}`").alias("page_id"),
                         F.col(f"`{url_col}`").cast("string").alias("url"))
            .groupBy("page_id", "url").agg(F.count("*").alias("copies"))
            .withColumn("host", F.coalesce(host_of(F.col("url")), F.lit("")))
            .withColumn("path", F.coalesce(path_of(F.col("url")), F.lit(""))))
    parts = F.split("host", r"\.")
    longest = F.least(F.size(parts), F.lit(labels))
    hosts = F.transform(F.sequence(F.lit(0), longest),
                        lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."))
    paths = F.transform(F.sequence(F.lit(0), F.least(_depth(F.col("path")), F.lit(depth))),
                        lambda n: _upto(F.col("path"), n))
    expressions = F.flatten(F.transform(
        F.filter(hosts, lambda h: h != ""),
        lambda h: F.transform("paths", lambda p: F.sha2(F.concat(h, p), 256))))
    spread = (rows.withColumn("paths", paths)
              .select("page_id", "url", "host", "path", "copies",
                      F.explode_outer(expressions).alias("digest"))
              .withColumn("prefix", F.substring("digest", 1, PREFIX)))
    if (known[1] or 0) <= SMALL:
        met = spread.join(F.broadcast(keyed), "prefix", "left")
    else:
        met = skew_join(spread, keyed, ["prefix"], "left", hot_keys(spread, ["prefix"], HOT_ROWS))
    fits = (F.col("digest") == F.col("r_digest")) & F.startswith(F.col("path"), F.col("r_path"))
    rule = F.concat("r_host", "r_path")
    hit = F.when(fits, F.struct(F.length(rule).alias("length"), F.length("r_host").alias("of_host"),
                                rule.alias("rule"), F.col("r_verdict").alias("verdict")))
    best = met.groupBy("page_id", "url", "host", "path", "copies").agg(F.max(hit).alias("best"))
    return best.select("page_id", "url", "host", "path", F.col("best.rule").alias("rule"),
                       F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
                       F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("k")
                       ).drop("k")


def keep_allowed(pages: DataFrame, rules: DataFrame, url_col: str = "url",
                 default: str = "allow") -> DataFrame:
    """The rows of ``pages`` whose URL is allowed, with all their columns.

    URLs are judged once each, as ``judge`` does; a null URL gets the default.
    """
    url = F.col(f"`{url_col}`")
    urls = pages.select(url.alias("url")).distinct().withColumn("page_id", F.lit(None).cast("long"))
    found = judge(urls, rules, default=default).filter("verdict = 'block'").select(
        F.col("url").alias("blocked_url"))
    # Names of ``found`` may clash with those of ``pages``: the condition names its sides.
    return pages.alias("kept").join(
        found.alias("blocked"), F.col(f"kept.`{url_col}`").eqNullSafe(F.col("blocked.blocked_url")),
        "left_anti")
