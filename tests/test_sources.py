"""Files, logs, tables, databases and streams on small fixtures."""

import random
import re
import sqlite3
import tomllib

import pytest
from conftest import rows
from pyspark.sql import functions as F

from opspark.session import cut, measured, scratch_path, shared_folder
from opspark.sources import logs
from opspark.sources.database import export, split_ranges, split_read
from opspark.sources.files import (
    append_increment, incremental, materialise, part_manifest, read_csv, scan, scan_parts, write_csv,
    write_parquet, write_parts)
from opspark.sources.logs import ingest_logs, seat_flags, with_path_meta
from opspark.sources.tables import (
    join_buckets, key_layout, partitions, prefix_scan, row_key_view, write_bucketed, write_layout)
from opspark.sources.text import (
    ACCESS_LOG_FIELDS, ACCESS_LOG_PATTERN, coerce, json_table, regex_table)
from opspark.streaming.streams import (
    run_available, run_batches, running_agg, stage_files, stream_source)

GOOD = """
[1]
hand = 7
players = ["ann", "bob"]
blinds_or_straddles = [1, 2.0]
antes = [0.25, 0.25]
starting_stacks = [inf, 100]
winnings = [5, 0]
table = "t1"
venue = "Somewhere"
day = 3
time = "10:20:30"
actions = ["d dh p1 ????", "p1 cbr 4", "p2 cc", "d db AsKsQs", "p2 f"]
[2]
players = ["x"]
blinds_or_straddles = [1, 2]
actions = []
[3]
hand = "R-9"
players = ["x", "y"]
blinds_or_straddles = []
actions = []
"""


def test_ingest_logs(spark, tmp_path):
    keyed = tmp_path / "venue=PS" / "stake=0.25"
    plain = tmp_path / "AB-2009-07" / "mixed"
    for folder in (keyed, plain):
        folder.mkdir(parents=True)
    (keyed / "a.toml").write_text(GOOD)
    (plain / "b.toml").write_text(GOOD)
    (plain / "broken.toml").write_text("[1]\nhand = = 3")
    for stage in (None, scratch_path(spark, "stage")):
        t = ingest_logs(spark, str(tmp_path), "*.toml", stage)
        txns = {r["uid"]: r for r in t["txns"].collect()}
        assert set(txns) == {"PS:7", "AB:7"}
        assert (txns["PS:7"]["stake"], txns["AB:7"]["stake"]) == (.25, None)
        assert (txns["PS:7"]["venue_dir"], txns["AB:7"]["venue_dir"]) == (None, "AB-2009-07")
        assert (txns["PS:7"]["unit"], txns["PS:7"]["time"], txns["PS:7"]["seat_count"]) == (
            2.0, "10:20:30", 2)
        assert rows(t["seats"].filter("site = 'PS'"), "seat", "player", "stack", "payout") == [
            (1, "ann", float("inf"), 5.0), (2, "bob", 100.0, 0.0)]
        acts = t["actions"].filter("uid = 'PS:7'").orderBy("order").collect()
        assert [(r["actor"], r["verb"], r["target"]) for r in acts] == [
            (1, "ante", .25), (2, "ante", .25), (1, "post", 1.0), (2, "post", 2.0),
            (1, "cbr", 4.0), (2, "cc", None), (None, "board", None), (2, "f", None)]
        assert sorted(r["problem"] for r in t["quarantined"].collect()) == [
            "no_id", "no_id", "no_unit", "no_unit", "unreadable: TOMLDecodeError"]
    flags = rows(seat_flags(t["seats"], t["txns"]).filter("site = 'PS'"),
                 "seat", "is_first", "is_second", "is_last")
    assert flags == [(1, True, False, False), (2, False, True, True)]


def one_large_log():
    """Records whose strings and arrays hold what looks like headers, and some bad ones."""
    docs, rng = [], random.Random(4)
    for i in range(45):
        lines = [f"[{i}]" if i % 3 else f"[ 'id {i}' ]  # note", f"hand = {i}", "blinds_or_straddles = [1, 2]",
                 "players = ['ann', \"b[ob\"]", "starting_stacks = [10, 20.5]", "winnings = [3, 0]",
                 "actions = ['p1 cbr 4', 'd db x', 'p2 f']"]
        if i % 5 == 0:
            lines.append("note = '''\n" + "[7]\nhand = 1\n" * rng.randrange(1, 40) + "'''")
        if i % 7 == 0:
            lines.append('more = """say \\""" [8]\n[9]\n' + "'" * 3 + '\n"""')
        if i % 4 == 0:
            lines.append("deep = [\n[\n1\n],\n[2]\n]")
        if i % 11 == 0:
            lines.append("[%s.sub]\nx = 1" % (i if i % 3 else f"'id {i}'"))
        if i == 20:
            lines.append("bad = = 1")
        docs.append("\n".join(lines))
    return "\n".join(docs) + "\n"


@pytest.mark.parametrize("size", [400, 128 << 20])
def test_one_file_is_read_by_ranges_of_any_size(spark, tmp_path, size):
    text = one_large_log()
    (tmp_path / "venue=X" / "stake=1").mkdir(parents=True)
    (tmp_path / "venue=X" / "stake=1" / "large.toml").write_text(text)
    (tmp_path / "venue=X" / "stake=1" / "empty.toml").write_text("")
    (tmp_path / "venue=X" / "stake=1" / "open.toml").write_text("stray = 1\n[1]\nx = '''\n[2]\n")
    good = tomllib.loads(text.replace("bad = = 1", "bad = 1"))
    was = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes",
                                          "spark.sql.files.openCostInBytes")}
    try:
        for k in was:
            spark.conf.set(k, size)
        t = ingest_logs(spark, str(tmp_path), stage=scratch_path(spark, "stage"))
        txns = t["txns"].collect()
        assert sorted(int(r.txn_id) for r in txns) == [i for i in range(45) if i != 20]
        assert len(good) == 45 and all(r.site == "X" and r.n_players == 2 for r in txns)
        assert rows(t["seats"], "player") == [("ann",)] * 44 + [("b[ob",)] * 44
        assert t["actions"].count() == 44 * 5
        assert sorted(r.problem for r in t["quarantined"].collect()) == [
            "unreadable: AttributeError", "unreadable: TOMLDecodeError", "unreadable: TOMLDecodeError"]
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_path_meta(spark):
    df = spark.createDataFrame([("/d/venue=A/stake=2/f",), ("/d/B-2009-x/0.5/f",),
                                ("/d/venue=A/stake=n/f",)], "path string")
    assert rows(with_path_meta(df), "site", "venue_dir", "stake") == [
        ("A", None, 2.0), ("A", None, None), ("B", "B-2009-x", .5)]


def test_text(spark):
    df = spark.createDataFrame([('h - u [t t] "GET / HTTP/1.1" 200 -',), ("nonsense",)], "l string")
    got = rows(regex_table(df, "l", ACCESS_LOG_PATTERN, ACCESS_LOG_FIELDS))
    assert got == [("h", "-", "u", "[t t]", '"GET / HTTP/1.1"', "200", "-"), (None,) * 7]
    j = spark.createDataFrame([('{"a": 1, "b": "x"}',), ("bad",)], "m string")
    assert rows(json_table(j, "m", "a int, b string")) == [(1, "x"), (None, None)]
    c = spark.createDataFrame([("1.00005", "3.9", "y"), ("x", "inf", None)],
                              "a string, b string, c string")
    out = coerce(c, {"a": "double", "b": "int"}).collect()
    assert [(r["a"], r["b"]) for r in out] == [(1.0001, 3), (None, None)]


def test_files(spark, tmp_path):
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    path = str(tmp_path / "t")
    write_parquet(df.repartition(4), path)
    assert write_parquet(df.repartition(2), path).count() == 100
    assert 0 < scan(spark, path, parts=1).count() < 100
    assert scan(spark, path, ["v"]).columns == ["v"]
    first = materialise(df, str(tmp_path / "m"))
    again = materialise(df.limit(3), str(tmp_path / "m"))
    assert first.count() == again.count() == 100
    assert materialise(df.limit(3), str(tmp_path / "m"), rebuild=True).count() == 3
    write_csv(df, str(tmp_path / "c"), single=True)
    assert rows(read_csv(spark, str(tmp_path / "c"), "id bigint, v bigint")) == rows(df)
    target = str(tmp_path / "inc")
    assert append_increment(df.filter("id < 40"), "id", target) == 39
    assert append_increment(df, "id", target) == 99
    assert append_increment(df, "id", target) == 99
    assert spark.read.parquet(target).count() == 100
    assert incremental(df, "id", None).count() == 100


def test_projection_and_filter_reach_the_scan(spark, sf):
    df = scan(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_quantity"]).filter("l_quantity > 10")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,10.0)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_layout_prunes_partitions(spark, sf, tmp_path):
    c = spark.read.parquet(f"{sf}/customer.parquet")
    t = write_layout(c, "layout_test", "c_mktsegment", "c_nationkey", 4, "c_nationkey",
                     str(tmp_path / "layout"))
    assert t.count() == c.count() and partitions(spark, "layout_test").count() == 5
    plan = t.filter("c_mktsegment = 'BUILDING'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(c_mktsegment" in plan
    spark.sql("DROP TABLE layout_test")


def test_row_keys(spark):
    df = spark.createDataFrame([("b-x", 7, 1), ("b-x", 12345678, 2), ("c", 1, 3)],
                               "p string, i int, v int")
    view = row_key_view(df, "p", "i", {"f": ["v"]})
    assert [r[0] for r in view.select("row_key").collect()] == [
        "BX#000007", "BX#12345678", "C#000001"]
    assert prefix_scan(view, "BX#").count() == 2
    assert key_layout(df, ["p"], [F.desc("i")]).count() == 3


def test_split_ranges():
    assert split_ranges(1, 10, 3) == [(1, 3), (4, 6), (7, 10)]
    assert split_ranges(5, 6, 8) == [(5, 5), (6, 6)]


def test_database_round_trip(spark, tmp_path):
    db = str(tmp_path / "t.db")
    con = sqlite3.connect(db)
    con.execute("CREATE TABLE t (id INTEGER PRIMARY KEY, name TEXT)")
    con.executemany("INSERT INTO t VALUES (?, ?)", [(i, f"n{i}") for i in range(1, 24)])
    con.execute("CREATE TABLE out (id INTEGER PRIMARY KEY, name TEXT)")
    con.commit()
    df = split_read(spark, "sqlite3", db, "t", "id", "id bigint, name string", 4)
    assert df.rdd.getNumPartitions() == 4
    assert rows(df) == sorted([(i, f"n{i}") for i in range(1, 24)], key=repr)
    for _ in range(2):
        export(df.coalesce(1), "sqlite3", db, "out", ["id"], batch=10)
    assert con.execute("SELECT count(*), sum(id) FROM out").fetchone() == (23, 276)
    con.close()
    with pytest.raises(ValueError):
        export(df, "sqlite3", db, "out", ["nope"])


def test_stream_equals_batch(spark, tmp_path):
    df = spark.range(300).select((F.col("id") % 3).alias("k"), "id")
    path = str(tmp_path / "in")
    for i in range(3):
        df.filter(F.col("id") % 3 == i).write.mode("append").parquet(path)
    stream = stream_source(spark, path, "k bigint, id bigint", files_per_batch=1)
    out = run_available(running_agg(stream, ["k"], [F.sum("id").alias("s")]), str(tmp_path / "out"),
                        str(tmp_path / "cp"))
    assert rows(out) == rows(df.groupBy("k").agg(F.sum("id").alias("s")))


def test_session_helpers(spark):
    assert shared_folder(spark) == shared_folder(spark)
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    assert cut(spark.range(5)).count() == 5
    small = measured(spark.range(100).groupBy((F.col("id") % 3).alias("k")).count())
    plan = spark.range(10).withColumn("k", F.col("id")).join(
        small, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    small.unpersist()


def test_large_side_is_not_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        side = measured(spark.range(5000).withColumnRenamed("id", "k"))
        plan = spark.range(10000).withColumnRenamed("id", "k").join(
            side, "k")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        side.unpersist()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_tables_bucketed_alike_are_joined_without_an_exchange(spark, tmp_path):
    a = spark.range(2000).select((F.col("id") % 500).alias("key"), F.col("id").alias("a"))
    b = spark.range(500).select(F.col("id").alias("key"), (F.col("id") * 2).alias("b"))
    tables = [write_bucketed(df, f"bucketed_{n}_{tmp_path.name}", "key", 4, str(tmp_path / n))
              for n, df in (("a", a), ("b", b))]
    total = join_buckets(*tables, "key").groupBy("key").agg(F.sum("a").alias("a"), F.max("b").alias("b"))
    plan = total._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert rows(total) == rows(a.join(b, "key").groupBy("key").agg(F.sum("a"), F.max("b")))


def test_parts_of_one_manifest_hold_the_same_keys(spark, tmp_path):
    heads = spark.range(1000).select((F.col("id") * F.col("id")).alias("key"), F.lit("h").alias("x"))
    lines = heads.unionByName(heads).unionByName(spark.createDataFrame(
        [(None, "none"), (-5, "low"), (10**9, "high")], "key long, x string"))
    manifest = part_manifest(heads, "key", 8)
    assert manifest.count() == 8
    for name, df in (("h", heads), ("l", lines)):
        write_parts(df, "key", manifest, str(tmp_path / name))
    for n in (1, 3, 8, None):
        h, l = (scan_parts(spark, str(tmp_path / t), heads.schema, n) for t in "hl")
        assert l.filter("x = 'h'").join(h, "key", "left_anti").isEmpty()
        assert l.filter("x = 'h'").count() == 2 * h.count()
        assert abs(h.count() - 1000 * (n or 8) / 8) <= 10
        assert l.filter("x IN ('none', 'low')").count() == 2
        assert n is None or "PartitionFilters: [isnotnull(part" in h._jdf.queryExecution().toString()
    assert scan_parts(spark, str(tmp_path / "l"), heads.schema, None, ["x"]).count() == lines.count()
    one = part_manifest(heads, "key", 1)
    assert [(r.part, r.lo) for r in one.collect()] == [(0, None)]
    same = part_manifest(heads.withColumn("key", F.lit(7)), "key", 5)  # one key: no more cuts than it allows
    assert [r.lo for r in same.orderBy("part").collect()] == [None, 7]


def test_a_stopped_consumer_goes_on_and_another_reads_all(spark, tmp_path):
    df = spark.range(600).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    staged = stage_files(df, str(tmp_path / "in"), 6)
    source = stream_source(spark, staged, df.schema, files_per_batch=1)
    totals = running_agg(source, ["k"], [F.count("*").alias("n"), F.sum("v").alias("v")])
    want = rows(df.groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("v")))
    place, state = str(tmp_path / "one"), str(tmp_path / "one-state")
    assert run_batches(totals, place, state, 2) == 2
    part = spark.read.parquet(place).agg(F.sum("n")).first()[0]
    assert 0 < part < 600
    assert rows(run_available(totals, place, state)) == want
    assert rows(run_available(totals, str(tmp_path / "two"), str(tmp_path / "two-state"))) == want
    assert run_batches(totals, str(tmp_path / "three"), str(tmp_path / "three-state"), 99) == 6


def test_simple_records_read_as_toml_reads_them(monkeypatch):
    simple = [
        b'[h1]\nhand = 7\nx = -0\ny = -0.0\nz = 1.50\nok = true\ns = "inf # [a] = \xc3\xa9"\n'
        b'a = []\nb = [inf, 100, -2.5]\nc = ["inf", "d,db"]\nd = inf\n\n', b"[h-2]\n\nx = 1"]
    odd = [b"[h1]\nx = 1\nx = 2", b"[h1]\nx = Infinity", b"[h1]\nx = null", b"[h1]\nx = 01",
           b"[h1]\nx = 1_0", b"[h1]\nx = 1 # c", b'[h1]\nx = "a\\u0041"', b'[h1]\nx = "a\tb"',
           b'[h1]\nx = "\x7f"', b'[h1]\nx = ["a", 1]', b"[h1]\nx = [1, 2,]", b"[h1]\nx = -inf",
           b"[h.g]\nx = 1", b'["h 1"]\nx = 1', b"x = 1", b"[h1]", b"[h1]\nx = {a = 1}",
           b'[h1]\nx = "\xff"', b"[h1]\nx = 1e3", b"[h1]\ntrue = 1\nx = [[1], [2]]"]

    def read(load, text):
        try:
            return repr(load(text))
        except ValueError as error:
            return type(error).__name__

    for text in simple + odd:
        assert read(logs._loads, text) == read(lambda t: tomllib.loads(t.decode("utf-8")), text), text
    monkeypatch.setattr(logs.tomllib, "loads", lambda text: {})
    assert all(logs._loads(text) for text in simple)  # without the slow reader


def test_lines_without_brackets_are_not_looked_into(monkeypatch):
    seen = []
    found = logs.line_state
    monkeypatch.setattr(logs, "line_state", lambda line, mode: seen.append(line) or found(line, mode))
    one = logs.Range("p", 0)
    for line in (b"[h1]", b"x = 1", b'y = "a', b"z = [", b"1]", b"t = '''[", b"]", b"'''"):
        one.add(line)
    assert (one.mode, one.depth) == ("", 0)
    assert one.others == {"": ["", 0], "'''": ["'''", 0], '"""': ['"""', 0]}
    assert "x = 1" not in seen and seen.count("z = [") == 1


def test_path_columns_where_folders_lack(spark):
    paths = ["/l/venue=a/stake=2/f", "/l/b-2009/0.5/f", "2/f", "f", "/2/f", "b//f", "b/2/", "", "//", None]
    got = with_path_meta(spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, path string"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract" not in plan  # tries every place of a path
    old = {i: (re.search("([^/]+)/[^/]+$", p), re.search("([^/]+)/[^/]+/[^/]+$", p))
           for i, p in enumerate(paths) if p is not None}
    for r in got.collect():
        if r.path is None:
            assert (r.site, r.venue_dir, r.stake) == (None, None, None)
            continue
        parent, grand = (m.group(1) if m else "" for m in old[r.i])
        if grand.startswith("venue="):
            assert (r.site, r.venue_dir) == (grand[6:], None)
        else:
            assert (r.site, r.venue_dir) == (grand.split("-")[0], grand)
        assert r.stake == {"stake=2": 2.0, "0.5": 0.5, "2": 2.0}.get(parent)
