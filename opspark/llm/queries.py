"""The corpus operators over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opspark.llm.alignment import align
from opspark.llm.bpe import round_trip
from opspark.llm.decontaminate import leaks
from opspark.llm.lm import score, train
from opspark.llm.manifest import audit, path_text
from opspark.llm.minhash import near_duplicates
from opspark.llm import pii, url_rules
from opspark.llm.quality_rules import screen
from opspark.llm.secrets import BASE, find_secrets, span_text
from opspark.llm.substring import remove_repeats
from opspark.llm.token_files import check_sequences, write_sequences
from opspark.llm.url_rules import judge, rule_table
from opspark.llm.warc import read_archives, write_archives

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Where an installed public tokenizer file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def count_kind(spans: str, kind: str) -> Column:
    return (F.size(F.filter(spans, lambda x: x["kind"] == F.lit(kind))).cast("long")
            .alias(f"n_{kind}"))


# Fixed pattern: words are runs of anything but a blank and the characters 9 to 13.
WORDS_SQL = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
LOWER_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {WORDS_SQL.format(LOWER_SQL)} AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 OR ws IS NULL THEN [] WHEN len(ws) < 5
    THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (sh)
      WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.b AS component_id, d.doc_id = m.b AS kept
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT a, min(b) AS b FROM r GROUP BY a) m ON m.a = d.doc_id""")
def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query(f"""
WITH w AS (
  SELECT doc_id, coalesce({WORDS_SQL.format("text")}, []) AS ws FROM documents),
s AS (
  SELECT doc_id, unnest(range(1, len(ws) - 18)) AS p,
         unnest(list_transform(range(1, len(ws) - 18), lambda i: md5(array_to_string(ws[i:i + 19], ' '))))
           AS k
  FROM w WHERE len(ws) >= 20),
f AS (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS rn FROM s),
g AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS p FROM f WHERE rn > 1),
a AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n
      FROM a ANTI JOIN g USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)""")
def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), with_text=False).drop("kept_text")


@query()
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = round_trip(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


@query()
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_sequences(write_sequences(table(spark, sf_dir, "documents"),
                                           tokenizer("byte_bpe_50k.json")))


@query()
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["rank"] < len(BASE))
    return found.select(
        "doc_id", *[count_kind("spans", k) for k in BASE],
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"))


@query(f"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS text, coalesce({WORDS_SQL.format("text")}, []) AS ws
  FROM documents),
t AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS p,
             unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i:i + 2])) AS k
      FROM w WHERE len(ws) >= 3),
u AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, k) AS n FROM t),
r AS (SELECT doc_id, count(DISTINCT q) AS n FROM (
        SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM u WHERE n > 1) GROUP BY doc_id),
l AS (SELECT doc_id, source, md5(text) AS copy, unnest(string_split(text, chr(10))) AS line FROM w),
g AS (SELECT doc_id, source, copy, line, {WORDS_SQL.format("line")} AS ls FROM l),
d AS (SELECT doc_id, sum(n - 1)::BIGINT AS n FROM (
        SELECT doc_id, line, count(*) AS n FROM g WHERE len(ls) > 0 GROUP BY 1, 2) GROUP BY 1),
m AS (SELECT *, {LOWER_SQL.replace("text", "array_to_string(ls, ' ')", 1)} AS norm FROM g
      WHERE len(ls) > 0),
c AS (SELECT source, norm, count(DISTINCT copy) AS n FROM m GROUP BY 1, 2),
h AS (SELECT source, count(DISTINCT md5(text)) AS size FROM w GROUP BY 1),
o AS (SELECT source, norm FROM c JOIN h USING (source) WHERE n > 20 AND (n > size * 0.1 OR n > 10000)),
x AS (SELECT doc_id, sum(len(ls)) AS lost FROM m SEMI JOIN o USING (source, norm) GROUP BY 1),
f AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(d.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         coalesce(lost, 0)::BIGINT AS n_lost
  FROM w LEFT JOIN d USING (doc_id) LEFT JOIN r USING (doc_id) LEFT JOIN x USING (doc_id))
SELECT * EXCLUDE (n_lost), n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_lost <= 0.5 * n_words AS kept, n_lost
FROM f""")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return screen(table(spark, sf_dir, "documents")).drop("clean_text")


# SHA-1 in base 32, from its hexadecimal form: five digits are four characters.
BASE32_SQL = """array_to_string(list_transform(range(0, 8), lambda i: array_to_string(list_transform(
  range(0, 4), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
    (CAST('0x' || substr(sha1({0}), 1 + 5 * i, 5) AS BIGINT) >> (15 - 5 * j)) & 31 AS INT), 1)),
  '')), '')"""


@query(f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
t AS (SELECT html, max(page_id) AS top FROM p GROUP BY html)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
       {BASE32_SQL.format("html")} AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM p JOIN t USING (html)""")
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_archives(table(spark, sf_dir, "pages"))
    return read_archives(archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["rank"] < len(pii.KINDS))
    return found.select("doc_id", *[count_kind("spans", k) for k in pii.KINDS],
                        F.sha2(span_text(base), 256).alias("base_sha256"),
                        span_text(F.col("spans")).alias("spans"))


@query()
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs))


@query()
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"),
                  tokenizer("piece_bpe_32k.model"), keep_groups=False)
    return found.withColumnRenamed("groups", "groups_sha256")


# The rules of the query, (verdict, host and path).
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/")]


@query(f"""
WITH p AS (
  SELECT row_number() OVER () AS u, page_id,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS text
  FROM pages),
h AS (SELECT u, page_id, {LOWER_SQL.replace("text", "regexp_extract(text, '^[^/?#]*')", 1)} AS host,
             regexp_extract(text, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r AS (SELECT *, rh || rp AS rule FROM (VALUES
  {", ".join("('{}', '/{}', '{}')".format(*r.split("/", 1), v) for v, r in RULES)}) t(rh, rp, verdict)),
m AS (SELECT u, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
      FROM h JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY u)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM h LEFT JOIN m USING (u)""")
def op12_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), rule_table(spark, RULES)).drop("url")


# H of a row's fields; the crc32 of the id's digits, from a table made bit by bit; and the
# levels of a tree of ``base`` (g, idx, n, d) as nodes, then as steps under each run.
LEAF_SQL = "sha256(" + " || ".join(
    f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')"
    for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
TREE_SQL = """{0} AS (
  SELECT 0 AS lvl, g, idx, n, d FROM {1}
  UNION ALL
  SELECT lvl + 1, g, idx // 16, (n + 15) // 16, sha256(string_agg(d, '' ORDER BY idx))
  FROM {0} WHERE n > 1 GROUP BY lvl, g, idx // 16, n),
{0}_runs AS (SELECT lvl, g, idx // 16 AS run, list(d ORDER BY idx) AS ds FROM {0} WHERE n > 1
             GROUP BY ALL)"""
STEP_SQL = """struct_pack(l := array_to_string(ds[:{0}], ''), r := array_to_string(ds[{0} + 2:], ''))"""


@query(f"""
WITH RECURSIVE c AS (
  SELECT list_transform(range(256), lambda x: list_reduce(range(8), lambda a, b:
           CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, x)) AS t),
f AS (
  SELECT doc_id, coalesce('g' || source, '') AS g, {LEAF_SQL.format(text="text")} AS leaf,
         {LEAF_SQL.format(text=LOWER_SQL)} AS low,
         xor(4294967295, list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda z: ascii(z)::BIGINT),
             lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)]), 4294967295)) % 5 = 0 AS changed
  FROM documents, c),
a AS (SELECT g, row_number() OVER (PARTITION BY g ORDER BY doc_id, leaf) - 1 AS idx,
             count(*) OVER (PARTITION BY g) AS n, leaf AS d, doc_id, low, changed FROM f),
{TREE_SQL.format("t1", "a")},
b AS (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS idx, count(*) OVER () AS n, d, g AS name
      FROM t1 WHERE n = 1),
{TREE_SQL.format("t2", "b")},
s AS (
  SELECT a.g, a.idx, lvl AS k, {STEP_SQL.format("(a.idx >> (4 * lvl)) % 16")} AS step
  FROM a JOIN t1_runs r ON r.g = a.g AND r.run = a.idx >> (4 * lvl + 4)
  UNION ALL
  SELECT a.g, a.idx, 100 + lvl, {STEP_SQL.format("(b.idx >> (4 * lvl)) % 16")}
  FROM a JOIN b ON b.name = a.g JOIN t2_runs r ON r.run = b.idx >> (4 * lvl + 4)),
p AS (SELECT g, idx, list(step ORDER BY k) AS steps FROM s GROUP BY 1, 2),
z AS (
  SELECT doc_id, a.d AS leaf, b.d AS subroot, t2.d AS root, coalesce(steps, []) AS steps,
         CASE WHEN changed THEN low ELSE a.d END AS base
  FROM a JOIN b ON b.name = a.g JOIN t2 ON t2.n = 1 LEFT JOIN p ON p.g = a.g AND p.idx = a.idx),
y AS (
  SELECT *, list_reduce(list_prepend(struct_pack(l := base, r := ''), steps), lambda u, v:
           struct_pack(l := sha256(v.l || u.l || v.r), r := '')).l AS folded_root
  FROM z)
SELECT doc_id, leaf, subroot, root,
       sha256(array_to_string(list_transform(steps, lambda v: v.l || v.r), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM y""")
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    found = audit(table(spark, sf_dir, "documents"), changed,
                  F.translate("text", url_rules.UPPER, url_rules.LOWER))
    return found.select("doc_id", "leaf", "subroot", "root",
                        F.sha2(path_text(F.col("path")), 256).alias("proof_sha256"),
                        "folded_root", "verified")
