"""URL rules against a plain loop over all rules."""

import random
import re
from collections import Counter

import pytest

from opspark.llm import url_rules
from opspark.llm.queries import RULES
from opspark.llm.url_rules import judge, keep_allowed, rule_table


def low(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match("([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    return low(host), path


def plain(url, rules, default="allow"):
    host, path = parts(url)
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, 0, None, default))
    return host, path, best[2], best[3]


ODD_URLS = [
    None, "", "://", "http://", "http:///x", "no scheme com/en/", "http://com", "http://COM/",
    "http://Example.COM/en/", "http://www.example.com/en/1?q=/x", "http://xexample.com/en/",
    "http://a.net/es", "http://a.net/es/", "http://net/fr/?x", "http://.net/fr/", "http://net./fr/",
    "http://a..net/es/#t", "http://a.net:80/es/", "http://u@a.net/es/", "http://a.net?/es/",
    "http://a.net//es/", "a://b://c.com/", "http://İ.com/é", "HTTP://WWW.EXAMPLE.COM/EN/",
    "http://" + ".".join(["a"] * 3000) + ".net/" + "es/" * 3000, "http://x.com/\n/y",
]


def pages(spark, urls):
    rows = [(i, u, "r", "v", 1) for i, u in enumerate(urls)]
    rows += [(None, "http://x.net/es/", "r", "v", 1)] * 2 + [(3, "http://x.com/", None, None, 1)] * 3
    return spark.createDataFrame(rows, "page_id long, url string, rule string, verdict string, "
                                       "`a.b` int")


def check(found, rows, rules, default="allow"):
    want = Counter((r.page_id, r.url, *plain(r.url, rules, default)) for r in rows.collect())
    assert found.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    assert Counter(map(tuple, found.collect())) == want


@pytest.mark.parametrize("small", [8_000_000, 0])
def test_the_query_rules_on_odd_urls(spark, monkeypatch, small):
    monkeypatch.setattr(url_rules, "SMALL", small)  # 0: the rules are shuffled
    monkeypatch.setattr(url_rules, "HOT_ROWS", 3)
    rows = pages(spark, ODD_URLS)
    rules = [(*re.match("([^/]*)(.*)", r).groups(), v) for v, r in RULES]
    check(judge(rows, rule_table(spark, RULES)), rows, rules)
    check(judge(rows, rule_table(spark, RULES), default="block"), rows, rules, "block")


@pytest.mark.parametrize("small", [8_000_000, 0])
def test_random_rules_of_any_depth(spark, monkeypatch, small):
    monkeypatch.setattr(url_rules, "SMALL", small)
    monkeypatch.setattr(url_rules, "HOT_ROWS", 20)
    rng = random.Random(4)

    def host():
        return ".".join(rng.choice("abc") for _ in range(rng.randint(1, 4)))

    def path():
        return "".join("/" + rng.choice(["", "x", "xy", "y"]) for _ in range(rng.randint(0, 4)))

    urls = [f"http://{host()}{path()}{rng.choice(['', '?a=/x', '#x'])}" for _ in range(400)]
    rules = {(host(), path()): rng.choice(["allow", "block"]) for _ in range(60)}
    rules = [(*k, v) for k, v in rules.items()]
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    check(judge(pages(spark, urls), table), pages(spark, urls), rules)


def test_odd_rules(spark):
    rows = pages(spark, ["http://a.com/x", "http://b.com", "http://c.com/p"])
    table = spark.createDataFrame(
        [("A.com", "/", "allow", 1), ("a.com", "/", "block", 2), ("b.com", None, "block", 3),
         (None, "/", "block", 4), ("", "/", "block", 5), ("c.com", "p", "block", 6),
         ("c.com", "/", "maybe", 7), ("c.com", "/", None, 8), ("b.com", "", "block", 3)],
        "host string, path string, verdict string, url int")
    check(judge(rows, table), rows, [("a.com", "/", "block"), ("b.com", "", "block")])
    check(judge(rows, table.limit(0)), rows, [])
    assert judge(rows.limit(0), table).count() == 0


def test_blocked_pages_go_with_all_their_columns(spark):
    rows = pages(spark, ODD_URLS).withColumnRenamed("verdict", "blocked_url")
    rules = [(*re.match("([^/]*)(.*)", r).groups(), v) for v, r in RULES]
    kept = keep_allowed(rows, rule_table(spark, RULES))
    assert kept.columns == rows.columns
    want = Counter(tuple(r) for r in rows.collect() if plain(r.url, rules)[3] == "allow")
    assert Counter(map(tuple, kept.collect())) == want and sum(want.values()) < rows.count()
