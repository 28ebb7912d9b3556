"""The pipeline against a plain version, stage by stage."""

import hashlib
import random
import re
from collections import Counter

import public_tokenizers
from llm_cases import clashing, odd_docs
from pyspark.sql import functions as F
from test_decontaminate import plain as distance
from test_documents import copies, naive_figures, prose, shingle_set
from test_pii import plain as personal
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import queries
from opspark.llm.decontaminate import normal

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def fixture():
    rng = random.Random(12)
    items = [(i, " ".join(prose(rng, 12))) for i in range(4)]
    base = prose(rng, 120)
    texts = copies(rng, 25, base, 5) + [" ".join(prose(rng, 60)) for _ in range(30)]
    texts += ["a b c " * 40, "short one", "", None]
    texts += [" ".join(prose(rng, 30) + [t.replace("w1", "W7", 1)] + prose(rng, 25)) for _, t in items]
    texts += [" ".join(prose(rng, 60)) + f" mail me{i}@x.org or +1 (555) 010-999{i}" for i in range(5)]
    foot = "this very footer stands below all texts"
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    rows += [(500 + i, " ".join(prose(rng, 70)) + "\n" + foot, "en", None, 0) for i in range(24)]
    return rows, items, foot


def naive(rows, items, foot):
    docs = {}
    for i, text, _, source, _ in rows:
        n, *_, repeat = naive_figures(text)
        lines = [x for x in (text or "").split("\n") if not (source is None and x == foot)]
        lost = n - sum(len(x.split()) for x in lines)
        if n >= 50 and 100 * repeat <= 50 * n and lost <= n / 2:
            docs[i] = "\n".join(lines)
    sets = {i: shingle_set(t) for i, t in docs.items()}
    group: dict[int, int] = {}
    for i in sorted(sets):
        todo, group[i] = [i], group.get(i, i)
        while todo:
            x = todo.pop()
            for y in sets:
                if y not in group and 100 * len(sets[x] & sets[y]) >= 85 * len(sets[x] | sets[y]):
                    group[y] = group[i]
                    todo.append(y)
    docs = {i: t for i, t in docs.items() if group[i] == i}
    good = [(normal(t), len(normal(t)) // 10) for _, t in items]
    docs = {i: t for i, t in docs.items()
            if not any(distance(item, normal(t)) <= k for item, k in good)}
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = {}
    for i, t in docs.items():
        for kind, a, b in sorted(personal(t), key=lambda s: -s[1]):
            t = f"{t[:a]}[{kind.upper()}]{t[b:]}"
        ids = lib.encode(t, add_special_tokens=False).ids
        out[i] = ids, hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    return out


def test_run_equals_the_plain_version(spark, tmp_path):
    rows, items, foot = fixture()
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    got = queries()["pipeline"](spark, str(tmp_path)).collect()
    want = naive(rows, items, foot)
    assert {r.doc_id: (list(r.ids), r.decoded_sha256) for r in got} == want
    assert len(got) == len(want) and all(r.n_tokens == len(r.ids) for r in got)
    assert 20 < len(want) < 80


def test_stages_keep_the_columns_and_take_an_empty_or_odd_table(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    long = " ".join(f"q{i}" for i in range(60))
    odd = [(None, long, None, None, None), (1, None, "en", "s", 0), (2, "", "en", "s", 0),
           (3, long + " é", "en", "s", 5), (3, long + " é", "en", "s", 5)]
    for data, left in (([], 0), (odd, 2)):
        docs = spark.createDataFrame(data, COLUMNS)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert re.sub(" ", "", COLUMNS) == "".join(
                f"{c}{t.replace('bigint', 'long')}," for c, t in docs.dtypes)[:-1], name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == left


def test_stages_keep_clashing_columns_as_they_are(spark, tmp_path):
    """Null, empty, tied and repeated rows, with names that the stages use inside."""
    items = [(0, "one two three four five six seven eight nine ten eleven twelve")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    long = " ".join(f"q{i}" for i in range(70))
    other = spark.createDataFrame(
        [(50, long, "s", 1, "t"), (50, long, "s", 1, "t"), (51, long + " end", "s", 1, "t"),
         (None, long.replace("q", "z"), "s", 1, "t"),
         (52, long.replace("q", "y") + " " + items[0][1], "s", 1, "t")],
        "doc_id long, text string, n_words string, start long, spans string")
    docs = clashing(odd_docs(spark).unionByName(other).withColumn("source", F.lit("s"))
                    .withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long")))
    given = Counter(map(tuple, docs.drop("text", "n_chars").collect()))
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        alone, left = stage(spark, docs, str(tmp_path)), stage(spark, left, str(tmp_path))
        for found in (alone, left):
            assert found.columns == docs.columns and found.dtypes == docs.dtypes, name
            rows = Counter(map(tuple, found.select(*[
                F.col("`" + c.replace("`", "``") + "`") for c in docs.columns
                if c not in ("text", "n_chars")]).collect()))
            assert not rows - given, name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
        if name == "pii":
            assert alone.count() == docs.count()
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 50]
