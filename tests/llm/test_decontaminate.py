"""Edit matching against a plain dynamic programme."""

import random

import pytest
from llm_cases import odd_docs

from opspark.llm.decontaminate import (
    Finder, decontaminate, leaks, masks, myers, normal, pieces)


def plain(item, text):
    """Least edit distance of the item to any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item):
        new = [i + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(rng, text, n):
    s = list(text)
    for _ in range(n):
        i = rng.randrange(len(s) or 1)
        s[i:i + 1] = rng.choice(([], [rng.choice("abc d")], [*s[i:i + 1], rng.choice("abc d")]))
    return "".join(s)


@pytest.mark.parametrize("seed", range(6))
def test_distance_is_exact(seed):
    rng = random.Random(seed)
    for _ in range(150):
        item = "".join(rng.choices("ab c", k=rng.randrange(1, 90)))
        text = "".join(rng.choices("ab c", k=rng.randrange(60)))
        if rng.random() < 0.7:
            at = rng.randrange(len(text) + 1)
            text = text[:at] + edited(rng, item, rng.randrange(6)) + text[at:]
        want = plain(item, text)
        for limit in (0, 3, len(item)):
            got = myers(len(item), masks(item), text, limit)
            if text:
                assert (got[0] if got else None) == (want if want <= limit else None)


def test_no_copy_within_the_budget_is_missed():
    rng = random.Random(11)
    words = ["alpha", "be", "gamma", "del", "eps", "zeta", "the", "of"]
    for _ in range(200):
        item = normal(" ".join(rng.choices(words, k=rng.randrange(4, 40))))
        k, parts = pieces(item)
        assert len(parts) == k + 1 and "".join(p for _, p in parts) == item
        text = normal("x y " + edited(rng, item, rng.randrange(k + 4)) + " " +
                      " ".join(rng.choices(words, k=20)))
        got = Finder([(7, item)], 10).find(text)
        want = plain(item, text)
        assert bool(got) == (want <= k), (item, text)
        if got:
            assert got[0][0] == 7 and want <= got[0][1] <= k


def test_documents_with_items_go_in_any_block_size(spark):
    rng = random.Random(3)
    items = [(i, " ".join(f"w{rng.randrange(500)}" for _ in range(25))) for i in range(8)]
    clean = [" ".join(f"w{rng.randrange(500)}" for _ in range(60)) for _ in range(20)]
    rows = [(i, t, "x") for i, t in enumerate(clean)]
    rows += [(100 + i, clean[i] + " " + t.upper().replace(" ", ",\n") + "! " + clean[i + 1], "x")
             for i, t in items]
    docs = spark.createDataFrame(rows, "doc_id long, text string, leaks string")
    bench = spark.createDataFrame([*items, items[0], (None, "no id"), (9, None), (10, " ?! ")],
                                  "item_id long, text string")
    for size in (1, 400, 10**6):
        got = leaks(docs, bench, block_chars=size).collect()
        assert sorted((r.doc_id, r.item_id, r.distance) for r in got) == [
            (100 + i, i, 0) for i, _ in items]
    left = decontaminate(docs, bench)
    assert left.columns == ["doc_id", "text"]
    assert sorted(r.doc_id for r in left.collect()) == list(range(20))


def test_odd_rows(spark):
    docs = odd_docs(spark)
    bench = spark.createDataFrame([(1, "same text twice")], "item_id long, text string")
    assert sorted(r.doc_id for r in leaks(docs, bench).collect()) == [18, 19]
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate(docs, none).count() == docs.count()
    assert leaks(docs.limit(0), bench).count() == 0
