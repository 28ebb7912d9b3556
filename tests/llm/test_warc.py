"""Archives written and read back by byte ranges."""

import gzip
import random

import pytest

from opspark.llm import warc
from opspark.llm.warc import digest_of, read_archives, record, records_of, write_archives


def pages(spark):
    rng = random.Random(9)
    noise = "".join(chr(rng.randrange(32, 0x2000)) for _ in range(50_000))
    bodies = ["<p>a</p>", "", None, "é" * 5000, noise, "<p>a</p>", "WARC/1.1\r\nX: y\r\n\r\n", "\r\n\r\n"]
    rows = [(i, f"http://x/{i} é", bodies[i % len(bodies)], "p") for i in range(60)]
    rows += [(None, None, "<p>a</p>", None), (59, rows[59][1], rows[59][2], "p")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload string")


@pytest.mark.parametrize("split", [7, 1000, 2**20])
@pytest.mark.parametrize("least", [0, 9])
def test_records_come_back_once(spark, split, least):
    df = pages(spark)
    rows = df.collect()
    got = read_archives(write_archives(df.repartition(3), min_bytes=least), split).collect()
    assert len(got) == len(rows)
    html = {r.page_id: (r.html or "").encode() for r in rows}
    top = {}
    for r in rows:
        if r.page_id is not None and len(html[r.page_id]) >= least:
            top[html[r.page_id]] = max(r.page_id, top.get(html[r.page_id], -1))
    for g in got:
        body = html[g.page_id]
        want = top.get(body, g.page_id)
        assert (g.payload_bytes, g.payload_digest) == (len(body), digest_of(body))
        if g.page_id is None or want == g.page_id:
            assert (g.record_type, g.refers_to, bytes(g.payload)) == ("response", None, body)
        else:
            assert (g.record_type, g.refers_to, bytes(g.payload)) == ("revisit", want, b"")


def test_every_cut_of_a_file_gives_each_record_to_one_side(tmp_path):
    # Stored blocks keep the inner magic visible to the scan: it is no record.
    inner = b"\x1f\x8b\x08" + b"\0" * 20
    data = [record(i, "u", b"body%d" % i, "D", None, i) for i in range(3)]
    data.insert(1, gzip.compress(b"WARC/1.1\r\nContent-Length: 0\r\n\r\n" + inner, 0))
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(data))
    size = path.stat().st_size
    whole = [at for at, _ in records_of(str(path), size, 0, size)]
    assert len(whole) == 4
    for cut in range(size + 1):
        two = [[at for at, _ in records_of(str(path), size, a, b)] for a, b in ((0, cut), (cut, size))]
        assert set(whole) <= set(two[0] + two[1])
        assert two[0] == [at for at in whole if at < cut]


def test_members_are_plain_gzip(spark, tmp_path):
    row = write_archives(pages(spark).coalesce(1), folder=str(tmp_path)).first()
    with gzip.open(row.path) as f:
        assert f.read().count(b"WARC/1.1\r\nWARC-Type: ") == row.records
    assert row.bytes == len(open(row.path, "rb").read())


def test_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert read_archives(write_archives(none)).count() == 0
    assert warc.SPLIT_BYTES > warc.BLOCK
