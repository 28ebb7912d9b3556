"""Merkle manifests against a plain tree."""

import hashlib
import zlib
from collections import Counter

import pytest
from llm_cases import odd_docs
from pyspark.sql import functions as F

from opspark.llm import manifest
from opspark.llm.manifest import audit, fold, proofs
from opspark.llm.queries import op13_merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(nodes):
    """(root, path of each node) by the levels' definition."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            run = nodes[k // 16 * 16:k // 16 * 16 + 16]
            paths[i].append(("".join(run[:k % 16]), "".join(run[k % 16 + 1:])))
        nodes = [sha("".join(nodes[k:k + 16])) for k in range(0, len(nodes), 16)]
        at = [k // 16 for k in at]
    return nodes[0] if nodes else None, paths


def plain(leaves):
    """(group, digest) in order -> Counter of (group, digest, subroot, root, path)."""
    groups = {}
    for g, d in leaves:
        groups.setdefault(g, []).append(d)
    names = sorted(groups, key=lambda g: b"" if g is None else b"g" + g.encode())
    trees = [tree(groups[g]) for g in names]
    root, tops = tree([t[0] for t in trees])
    return Counter((g, d, sub, root, tuple(path + top)) for g, (sub, paths), top in
                   zip(names, trees, tops) for d, path in zip(groups[g], paths))


SIZES = {None: 3, "": 1, "a": 1, "b": 16, "c": 17, "d": 256, "e": 257, "é": 300, "z": 4100}


@pytest.mark.parametrize("digits,groups", [(3, 9), (1, 9), (2, 9), (3, 1), (1, 300)])
def test_proofs_equal_the_plain_tree(spark, monkeypatch, digits, groups):
    monkeypatch.setattr(manifest, "DIGITS", digits)  # fewer digits: more rollups
    monkeypatch.setattr(manifest, "BLOCK", 16 ** digits)
    sizes = list(SIZES.items())[-groups:] if groups < 10 else [(f"s{i}", 2) for i in range(groups)]
    rows = [(g, k, sha(f"{g}{k}")) for g, n in sizes for k in range(n)]
    df = spark.createDataFrame(rows, "grp string, doc_id long, digest string").repartition(7)
    got = proofs(df, ["doc_id"]).withColumn("folded", fold(F.col("leaf"), F.col("path"))).collect()
    found = Counter((r.grp, r.leaf, r.subroot, r.root, tuple(map(tuple, r.path))) for r in got)
    assert found == plain([(g, d) for g, _, d in rows])
    assert all(r.folded == r.root for r in got)


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return sha("".join(map(field, (r.doc_id, r.source, r.lang, r.n_chars, text))))


def odd(spark):
    docs = odd_docs(spark)
    return docs.select("*", F.when(F.col("doc_id") % 3 == 0, "S").when(F.col("doc_id") > 9, "")
                       .alias("source"), F.lit(None).cast("string").alias("lang"),
                       F.col("start").alias("n_chars"), F.lit(1).alias("grp"),
                       F.lit(2).alias("digest"), F.lit(3).alias("a.b"))


def test_nulls_ties_repeats_and_clashing_names(spark):
    docs = odd(spark).unionByName(odd(spark).filter("doc_id < 4"))
    rows = docs.collect()
    order = sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
    want = plain([(r.source, leaf(r, r.text)) for r in order])
    got = audit(docs, F.lit(True), F.upper("text")).collect()
    assert Counter((r.leaf, r.subroot, r.root, tuple(map(tuple, r.path))) for r in got) \
        == Counter({k[1:]: n for k, n in want.items()})
    same = Counter(r.verified for r in got)
    assert same[True] == sum(r.text is None or r.text.upper() == r.text for r in rows)
    assert same[False] == len(rows) - same[True]


def test_no_rows_and_one_row(spark):
    docs = odd(spark)
    assert audit(docs.limit(0), F.lit(False), F.col("text")).count() == 0
    r = audit(docs.filter("doc_id = 4"), F.lit(False), F.col("text")).first()
    assert r.leaf == r.subroot == r.root == r.folded_root and r.path == [] and r.verified


def test_tampered_rows_of_the_query_fail(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op13_merkle(spark, sf).collect():
        changed = zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and texts[r.doc_id] is not None \
            and any("A" <= c <= "Z" for c in texts[r.doc_id])
        assert r.verified == (not changed) and (r.folded_root == r.root) == r.verified
