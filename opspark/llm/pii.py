"""Personal data, and terms that give it away, in DataFrame operations only.

Base kinds are found by patterns. Positions come from the text cut at the matches:
the lengths of the parts and matches before a match add up to its start. Patterns
use possessive loops, so a match is the same but no text, however long or odd,
makes the matcher try a stretch twice.

Then the information-theoretic step. An entity c is one value (an address, a
number). Its contexts are the distinct stretches of ``REACH`` characters on both
sides of its mentions; copies of a passage are one context. A term t stands next to
c in n(c, t) of them. With n(t), the distinct corpus lines that hold t (or contexts,
where those are more), n(c, t) / n(t) estimates how surely t leads to c. p(c|t) is the
lower end of Wilson's interval of that ratio, ``Z`` standard errors wide: 1/2 for 1 of
1, 5/6 for 5 of 5. -log2 p(c|t) bits of the entity stay unknown to who reads t; the
term is strong where p(c|t) is ``DISCLOSED`` at least (one bit at most), whatever the
corpus' size.

A rare word may stand beside an entity by chance. So a random place of every text is
treated as an entity too. Terms are classed by contexts (``MANY`` and more are one
class) and by log2 n(t), and a class discloses only where random places show at most
``CHANCE`` of the strong terms a context that mentions show. Words seen once are thus
taken only where they gather around entities. Such terms are generalised in every
document that names the entity.

Lines are made distinct before their words are counted, so words reach the shuffle as
one row each and task. Rows without any candidate are never split at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opspark.llm.common import ROW, carried, named, stored, uncarried

# The kinds in their order and what they match.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    # A match starts where a run of local characters or the last match ends.
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Every match holds one of these.
CANDIDATE = r"@[A-Za-z0-9-]++\.|[0-9]\.[0-9]++\.[0-9]++\.[0-9]|[0-9](?:[\x20-]?[0-9]){15}|\+[0-9]"
BYTE = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
TERM = r"[\p{L}\p{N}]++"
REACH, Z, DISCLOSED, CHANCE, MANY = 80, 1.0, 0.5, 0.1, 3
SPAN = "array<struct<rank:int,start:long,stop:long,kind:string>>"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(c: Column) -> Column:
    """Whether the digits of ``c`` pass the check: from the right, every second doubled."""
    digits = F.split(F.reverse(_digits(c)), "(?!^)(?!$)")
    total = F.aggregate(
        F.transform(digits, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0))),
        F.lit(0), lambda a, d: a + d)
    return total % 10 == 0


def valid(kind: Column, match: Column) -> Column:
    """Whether a pattern's match is data of its kind."""
    n = F.length(_digits(match))
    return (F.when(kind == "email", True)
            .when(kind == "ip", match.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$"))
            .when(kind == "card", n.between(16, 19) & _luhn(F.when(n <= 19, match).otherwise("0")))
            .otherwise(n.between(8, 15)))


def matches(texts: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """(uid, kind, start, match, before, after) of every match in texts (uid, text).

    before and after: the characters within ``REACH`` of the match, up to the next
    match of its kind. A window per text and kind adds the lengths up.
    """
    cut = F.lit(None)
    for kind, pattern in patterns.items():
        cut = F.when(F.col("kind") == kind, F.struct(
            F.split("text", pattern, -1).alias("parts"),
            F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("found"))).otherwise(cut)
    kinds = F.explode(F.array(*map(F.lit, patterns)))
    rows = (texts.withColumn("kind", kinds).select("uid", "kind", cut.alias("c"))
            .filter(F.size("c.found") > 0)
            .select("uid", "kind", F.posexplode(F.arrays_zip(
                F.col("c.parts").alias("part"), F.col("c.found").alias("match"),
                F.slice("c.parts", 2, F.size("c.parts")).alias("next"))).alias("i", "x"))
            .select("uid", "kind", "i", F.length("x.part").cast("long").alias("gap"),
                    F.col("x.match").alias("match"), F.right("x.part", F.lit(REACH)).alias("before"),
                    F.left("x.next", F.lit(REACH)).alias("after")))
    order = W.partitionBy("uid", "kind").orderBy("i")
    run = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    passed = order.rowsBetween(W.unboundedPreceding, -1)
    start = F.sum("gap").over(run) + F.coalesce(
        F.sum(F.length("match").cast("long")).over(passed), F.lit(0))
    return (rows.withColumn("start", start).filter(F.col("match").isNotNull())
            .select("uid", "kind", "start", "match", "before", "after"))


def _terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def _context_terms(before: Column, after: Column) -> Column:
    """Terms of both sides in the mention's line, without words the reach has cut."""
    left, right = F.substring_index(before, "\n", -1), F.substring_index(after, "\n", 1)
    left = F.when(F.length(left) == REACH, F.regexp_replace(left, r"^[\p{L}\p{N}]++", "")) \
        .otherwise(left)
    right = F.when(F.length(right) == REACH, F.regexp_replace(right, r"(?<![\p{L}\p{N}])[\p{L}\p{N}]++$", "")) \
        .otherwise(right)
    return _terms(F.concat(left, F.lit("\n"), right))


def entity_of(kind: Column, match: Column) -> Column:
    """The entity a match names: numbers by their digits, addresses in lower case."""
    return F.concat_ws(":", kind, F.when(kind.isin("card", "phone"), _digits(match))
                       .otherwise(F.lower(match)))


def lower_bound(k: Column, n: Column, z: float = Z) -> Column:
    """The lower end of Wilson's interval for ``k`` of ``n``; it falls as ``n`` rises."""
    p = k / n
    return (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def random_places(texts: DataFrame) -> DataFrame:
    """(entity, before, after) of one place in every text that is not empty.

    The place follows from a hash of the text, so copies of a text give one place.
    Words that the place cuts in two are left out.
    """
    at = F.pmod(F.xxhash64("text"), F.length("text")).cast("int")
    first = F.greatest(at - REACH, F.lit(0))
    cut = texts.filter("text <> ''").select(
        F.concat(F.lit("~"), F.xxhash64("text")).alias("entity"),
        F.substring("text", first + 1, at - first).alias("before"),
        F.substring("text", at + 1, F.lit(REACH)).alias("after"))
    return cut.select("entity", F.regexp_replace("before", r"(?<![\p{L}\p{N}])[\p{L}\p{N}]++$", "")
                      .alias("before"),
                      F.regexp_replace("after", r"^[\p{L}\p{N}]++", "").alias("after"))


def disclosing_terms(mentions: DataFrame, places: DataFrame, texts: DataFrame,
                     disclosed: float = DISCLOSED, chance: float = CHANCE) -> DataFrame:
    """(entity, term): terms that disclose an entity, by corpus co-occurrence.

    ``mentions``: (entity, before, after); ``places``: the same of random places, each an
    entity of its own; ``texts``: (text), the whole corpus.
    """
    both = mentions.select(F.lit(True).alias("real"), "entity", "before", "after").unionByName(
        places.select(F.lit(False).alias("real"), "entity", "before", "after"))
    contexts = both.select("real", "entity", "before", "after").distinct()
    sizes = {r.real: r.n for r in contexts.groupBy("real").agg(F.count("*").alias("n")).collect()}
    pairs = stored(contexts.select("real", "entity", F.explode(_context_terms(
        F.col("before"), F.col("after"))).alias("term"))
        .groupBy("real", "entity", "term").agg(F.count("*").alias("n_ct")), "cooccurrence")
    # n(t) is at least the contexts of t: terms beside many entities are out before the join.
    likely = pairs.filter("real").groupBy("term").agg(
        F.max("n_ct").alias("best"), F.sum("n_ct").alias("n_m")).filter(
        lower_bound(F.col("best"), F.col("n_m")) >= disclosed)
    unlikely = pairs.filter("NOT real").groupBy("term").agg(F.sum("n_ct").alias("n_m")).filter(
        lower_bound(F.lit(1), F.col("n_m")) >= disclosed)
    beside = pairs.join(likely.select(F.lit(True).alias("real"), "term", "n_m").unionByName(
        unlikely.select(F.lit(False).alias("real"), "term", "n_m")), ["real", "term"])
    # Distinct lines first: then a term is one row a task, and copies count once.
    lines = texts.select(F.explode(F.split("text", "\n")).alias("line")).filter(
        F.col("line") != "").distinct()
    n_term = (lines.select(F.explode(_terms(F.col("line"))).alias("term"))
              .groupBy("term").agg(F.count("*").alias("n_l")))
    n_t = F.greatest("n_l", "n_m")
    strong = stored(beside.join(n_term, "term").withColumn("n_t", n_t)
                    .filter(lower_bound(F.col("n_ct"), F.col("n_t")) >= disclosed)
                    .select("real", "entity", "term", "n_ct", "n_t"), "strong")
    if not sizes.get(True):
        return strong.select("entity", "term")
    # What random places of the corpus show as strongly is no evidence.
    kind = [F.least("n_ct", F.lit(MANY)).alias("few"), F.floor(F.log2("n_t")).alias("size")]
    share = F.sum(F.when(F.col("real"), 1.0 / sizes[True]).otherwise(0.0))
    by_chance = F.sum(F.when(F.col("real"), 0.0).otherwise(1.0 / max(1, sizes.get(False, 0))))
    good = strong.groupBy(*kind).agg(share.alias("seen"), by_chance.alias("chance")).filter(
        F.col("chance") <= chance * F.col("seen")).select("few", "size")
    return (strong.filter("real").select("entity", "term", *kind).join(good, ["few", "size"])
            .select("entity", "term"))


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               with_terms: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows without any span, stored rows with candidates and their ``spans``).

    Both hold the columns of ``docs``. spans: (rank, start, stop, kind), by rank,
    then start; base kinds first, then ``term``. A row with candidates of which
    none is valid has an empty array.
    """
    text = F.col(text_col).cast("string")
    has = F.coalesce(text.rlike(CANDIDATE), F.lit(False))
    clean = docs.filter(~has)
    rows = stored(docs.filter(has).withColumn("_uid", F.monotonically_increasing_id()), "hits")
    hits = rows.select(F.col("_uid").alias("uid"), F.col(text_col).cast("string").alias("text"))
    kind = F.col("kind")
    found = stored(matches(hits, PATTERNS).filter(valid(kind, F.col("match")))
                   .withColumn("entity", entity_of(kind, F.col("match"))), "matches")
    rank = F.array_position(F.array(*map(F.lit, KINDS)), kind).cast("int") - 1
    spans = found.select("uid", F.struct(
        rank.alias("rank"), "start", (F.col("start") + F.length("match")).alias("stop"),
        "kind").alias("s"))
    if with_terms:
        corpus = docs.select(text.alias("text"))
        pairs = disclosing_terms(found.select("entity", "before", "after"),
                                 random_places(corpus), corpus)
        todo = (found.select("uid", "entity").distinct().join(pairs, "entity")
                .select("uid", "term").distinct())
        todo = stored(todo, "todo")
        words = (matches(hits.join(todo.select("uid").distinct(), "uid", "left_semi"),
                         {"term": TERM})
                 .withColumn("term", F.lower("match")).join(todo, ["uid", "term"], "left_semi"))
        spans = spans.unionByName(words.select("uid", F.struct(
            F.lit(len(KINDS)).alias("rank"), "start",
            (F.col("start") + F.length("match")).alias("stop"), "kind").alias("s")))
    per = spans.groupBy("uid").agg(F.sort_array(F.collect_list("s")).alias("spans"))
    base = F.filter("spans", lambda s: s["rank"] < len(KINDS))
    # A term inside personal data goes with it.
    apart = F.filter("spans", lambda s: (s["rank"] < len(KINDS)) | ~F.exists(
        "_base", lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])))
    per = (per.withColumn("_base", base).withColumn("spans", apart)
           .select(F.col("uid").alias("_uid"), "spans"))
    out = (rows.join(per, "_uid", "left")
           .withColumn("spans", F.coalesce("spans", F.array().cast(SPAN))).drop("_uid"))
    return clean, out


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) of every row's whole text (null: empty).

    Repeated rows give repeated results; a null id stays null. Further columns
    are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    clean, rows = find_spans(docs)
    return (rows.select("doc_id", "spans")
            .unionByName(clean.select("doc_id", F.array().cast(SPAN).alias("spans"))))


def _masked(text: Column, spans: str) -> Column:
    """The text with every span, merged where they overlap, replaced by its kind."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["stop"].alias("stop"), s["rank"].alias("rank"),
        s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    done = F.aggregate(ordered, start, lambda a, s: F.struct(
        F.greatest(a["at"], s["stop"]).alias("at"),
        F.when(s["start"] < a["at"], a["out"]).otherwise(F.concat(
            a["out"], F.substr(text, (a["at"] + 1).cast("int"),
                               F.greatest(s["start"] - a["at"], F.lit(0)).cast("int")),
            F.lit("["), F.upper(s["kind"]), F.lit("]"))).alias("out")))
    return F.concat(done["out"], F.substr(text, (done["at"] + 1).cast("int")))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with personal data and disclosing terms generalised to their kind.

    Rows and columns stay as they are, but for the text (a null stays null). A
    column named ``spans`` or ``_uid`` is kept as it is. Repeated rows are treated alike;
    an empty table stays empty.
    """
    rows = carried(docs, text=named(text_col).cast("string"))
    clean, hit = find_spans(rows, text_col="text")
    both = clean.select(ROW, "text").unionByName(
        hit.select(ROW, _masked(F.col("text"), "spans").alias("text")))
    text = F.col("text").cast(docs.schema[text_col].dataType)
    return uncarried(both, docs.columns, **{text_col: text})
