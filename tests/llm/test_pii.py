"""Personal data against a plain scan, and disclosing terms on a hand-made corpus."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest
import regex
from llm_cases import ODD_TEXTS, odd_docs

from opspark.llm.pii import KINDS, personal_data, sanitise
from opspark.llm.queries import op7_pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, match):
    digits = [int(c) for c in match if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        double = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(double) % 10 == 0
    return kind != "phone" or 8 <= len(digits) <= 15


def plain(text):
    return [(k, m.start(), m.end()) for k in KINDS for m in re.finditer(PLAIN[k], text or "")
            if good(k, m.group())]


def messy(rng):
    bits = ["a@b.co", "_", "@", ".", "x%y+z@d-e.fr.uk", "1.2.3.4", ".5", "256.1.1.1", "001.02.3.255",
            "4111111111111111", "4111 1111-1111 1111", " ", "-", "  ", "+1 (234) 567-8901", "+", "(",
            ")", "é", "🙂", "\n", "7", "12345", "mail", "4111111111111111" * 2, "٣", "+49.30.1234567"]
    return "".join(rng.choices(bits, k=rng.randrange(1, 30)))


def test_base_spans_equal_a_plain_scan(spark, tmp_path):
    rng = random.Random(8)
    texts = [*ODD_TEXTS, *[messy(rng) for _ in range(600)],
             "1 " * 20_000, "a." * 20_000 + "@x.y", "x@" + "b." * 20_000, "1." * 20_000, "9" * 60_000,
             "+1" + "(" * 30_000, "ab" * 40_000, "a@b.c " * 3000]
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in enumerate(texts)],
                               "doc_id long, text string, spans string, _uid int")
    got = {r.doc_id: [(s.kind, s.start, s.stop) for s in r.spans]
           for r in personal_data(df.repartition(4)).collect()}
    for i, t in enumerate(texts):
        assert [s for s in got[i] if s[0] in KINDS] == plain(t), (t or "")[:200]
    df.drop("_uid").write.parquet(f"{tmp_path}/documents.parquet")
    for r in op7_pii(spark, str(tmp_path)).collect():
        base = plain(texts[r.doc_id])
        line = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(s[0] == k for s in base) for k in KINDS]


def corpus():
    rng = random.Random(2)
    rows = []
    for i in range(300):
        rows.append((i, " ".join(f"w{rng.randrange(300)}" for _ in range(30))))
    for i in range(8):  # Quillfeather goes with one address, the other words do not
        near = " ".join(f"w{rng.randrange(300)}" for _ in range(4))
        rows.append((1000 + i, f"w1 Quillfeather {near}: pat@corp.example w2\nmore QUILLFEATHER"))
    # Nine copies are one context; another line holds the term without the address.
    rows += [(2000 + i, "w3 Copyterm kim@corp.example w4") for i in range(9)]
    return rows + [(3000, "w5 Copyterm w6")]


def test_terms_that_give_an_entity_away_are_found(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in personal_data(df).collect()}
    texts = dict(corpus())
    for i in range(8):
        terms = [texts[1000 + i][s.start:s.stop] for s in got[1000 + i] if s.kind == "term"]
        assert terms == ["Quillfeather", "QUILLFEATHER"]
    assert all(s.kind != "term" for i, spans in got.items() if i >= 2000 for s in spans)
    out = {r.doc_id: r.text for r in sanitise(df).collect()}
    assert out[5] == texts[5] and out[2001] == "w3 Copyterm [EMAIL] w4"
    assert out[1000].startswith("w1 [TERM] ") and out[1000].endswith(": [EMAIL] w2\nmore [TERM]")


@pytest.mark.parametrize("operator", [personal_data, sanitise])
def test_odd_rows(spark, operator):
    docs = odd_docs(spark)
    assert operator(docs).count() == docs.count()
    assert operator(docs.limit(0)).count() == 0
    if operator is sanitise:
        assert operator(docs).columns == docs.columns
        assert sorted(map(repr, operator(docs).collect())) == sorted(map(repr, docs.collect()))


def test_terms_of_few_contexts_are_found(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(30))) for i in range(3000)]
    rows += [(5000, "w1 Hollowmere w2 ann@corp.example w3"), (5001, "w4 Hollowmere ann@corp.example w5"),
             (5002, "Larkspur w9 +49 30 12345678 w7"), (5003, "w8 lonely w6")]
    got = {r.doc_id: r.spans for r in personal_data(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    terms = {i: [texts[i][s.start:s.stop] for s in got[i] if s.kind == "term"] for i in texts}
    assert terms[5000] == terms[5001] == ["Hollowmere"] and terms[5002] == ["Larkspur"]
    assert not any(terms[i] for i in texts if i not in (5000, 5001, 5002))


def plain_terms(rows):
    """Terms of each entity by the definition, from plain counts over all texts."""
    word, reach = regex.compile(r"[\p{L}\p{N}]+"), 80

    def beside(before, after):
        left, right = before.rsplit("\n", 1)[-1], after.split("\n", 1)[0]
        if len(left) == reach:
            left = regex.sub(r"^[\p{L}\p{N}]+", "", left)
        if len(right) == reach:
            right = regex.sub(r"[\p{L}\p{N}]+$", "", right)
        return {w.lower() for side in (left, right) for w in word.findall(side)}

    def bound(k, n):
        p = k / n
        return (p + 1 / (2 * n) - math.sqrt(p * (1 - p) / n + 1 / (4 * n * n))) / (1 + 1 / n)

    texts = [t for _, t in rows if t]
    real, n_l = set(), Counter()
    for t in texts:
        for kind in KINDS:
            found = list(re.finditer(PLAIN[kind], t))
            for i, m in enumerate(found):
                if good(kind, m.group()):
                    low = found[i - 1].end() if i else 0
                    high = found[i + 1].start() if i + 1 < len(found) else len(t)
                    key = m.group().lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", m.group())
                    real.add((f"{kind}:{key}", t[max(low, m.start() - reach):m.start()],
                              t[m.end():min(high, m.end() + reach)]))
    for line in {x for t in texts for x in t.split("\n") if x}:
        n_l.update({w.lower() for w in word.findall(line)})
    n_ct, n_m = Counter(), Counter()
    for entity, before, after in real:
        for term in beside(before, after):
            n_ct[entity, term] += 1
            n_m[term] += 1
    strong = {(e, t): (min(n, 3), int(math.log2(max(n_l[t], n_m[t])))) for (e, t), n in n_ct.items()
              if bound(n, max(n_l[t], n_m[t])) >= 0.5}
    return strong, len(real)


def test_terms_equal_plain_counts(spark):
    """Every strong term of a class that random places never show is found, and no other."""
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{rng.randrange(200)}" for _ in range(60))) for i in range(1500)]
    for i in range(30):
        near = " ".join(f"w{rng.randrange(200)}" for _ in range(rng.randrange(30)))
        rare = rng.choice(["", f"only{i}", "Twice", "Thrice", f"pair{i // 2}"])
        rows.append((2000 + i, f"{near} {rare} u{i // 2}@x.org {near}\nnext line"))
    rows += [(3000, None), (3001, ""), (2000, rows[-1][1])]
    got = personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    strong, _ = plain_terms(rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, set()).add(t)
    found = {(i, t[s.start:s.stop].lower()) for r in got for i in [r.doc_id] for s in r.spans
             if s.kind == "term" for t in texts[i] if t and len(texts[i]) == 1}
    want = {(i, term) for i, ts in texts.items() if len(ts) == 1 for t in ts if t
            for entity, term in strong if entity.split(":")[1] in t and term in t.lower().split()}
    assert found == want and len(want) > 10


def test_words_that_are_rare_everywhere_disclose_nothing(spark):
    """Each line has words of its own: those beside an address are no evidence."""
    rows = [(i, " ".join(f"x{i}y{k}" for k in range(40)) + (f" me{i}@x.org" if i % 20 == 0 else ""))
            for i in range(400)]
    got = personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum(len(r.spans) for r in got) == 20 and all(s.kind == "email" for r in got for s in r.spans)
