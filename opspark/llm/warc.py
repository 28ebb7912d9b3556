"""WARC archives: written by tasks, read back by byte ranges.

Writing. Payloads are grouped by their digest in Spark. Of equal payloads the row
with the largest id is the response; the others are revisits that point at it and
carry its HTTP header, but not its bytes. Every record is a gzip member of its
own. A task writes one file under a fresh name and returns a manifest row.

Reading. A file is cut into byte ranges, one task each. A task looks for the gzip
magic in its range, tries each candidate by inflating the beginning and checking
that a WARC header comes out, and owns the records that start inside its range.
It reads on past the range's end only to finish its last record, and holds one
record's bytes at a time. So one archive is read by many tasks, and a record on a
border belongs to exactly one of them. A magic inside compressed data cannot be
mistaken for a record: what is inflated has to begin with a WARC version line, and
bytes inside a record already read are passed over.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opspark.llm.common import batch_of, stored
from opspark.llm.files import file_system
from opspark.session import scratch_path

SPLIT_BYTES = 16 * 2**20
BLOCK = 2**20
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # pages carry no date


def digest_of(payload: bytes) -> str:
    """SHA-1 in upper-case base 32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers: int | None,
           number: int) -> bytes:
    """One record as a gzip member; ``refers`` is the response's id, for a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers is None else b"")
    uri = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "about:blank")
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{number}:{page_id}:{uri}")
    head = [f"WARC-Type: {'response' if refers is None else 'revisit'}",
            f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers is not None:
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-ID: {refers}"]
    data = VERSION + "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data + b"\r\n\r\n") + pack.flush()


MANIFEST = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())])


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = 0,
                   id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> DataFrame:
    """Write one archive per task; returns the stored manifest (path, bytes, records).

    Payloads under ``min_bytes`` are always responses. A null html is an empty
    payload, a null url is about:blank. Rows without an id are written without
    one and always as responses. A repeated row (same id and payload) is a
    response each time: it has no other page to refer to. Further columns are
    ignored.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1("html"))
    top = (rows.filter(F.octet_length("html") >= min_bytes).groupBy("sha")
           .agg(F.max("page_id").alias("top"), F.count("*").alias("n"))
           .filter("n > 1").select("sha", "top"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        fsys, name = file_system(path)
        out, size, count = None, 0, 0
        for batch in batches:
            for page_id, url, html, top_id in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    fsys.create_dir(name.rpartition("/")[0], recursive=True)
                    out = fsys.open_output_stream(name, compression=None)
                payload = html.encode("utf-8", "replace")
                refers = top_id if page_id is not None and top_id != page_id else None
                data = record(page_id, url, payload, digest_of(payload), refers, count)
                out.write(data)
                size, count = size + len(data), count + 1
        if out is not None:
            out.close()
            yield batch_of(MANIFEST, path=[path], bytes=[size], records=[count])

    return stored(rows.join(top, "sha", "left").select("page_id", "url", "html", "top")
                  .mapInArrow(run, "path string, bytes long, records long"), "warc-manifest")


class Window:
    """A file read forward in blocks, with absolute positions."""

    def __init__(self, stream, size: int, start: int):
        self.stream, self.size, self.start, self.data = stream, size, start, b""

    def upto(self, end: int) -> None:
        """Hold the bytes up to ``end``, or to the file's end."""
        while self.start + len(self.data) < min(end, self.size):
            at = self.start + len(self.data)
            more = self.stream.read_at(min(BLOCK, self.size - at), at)
            if not more:
                raise EOFError("the archive is shorter than its manifest says")
            self.data += more

    def drop(self, before: int) -> None:
        """Let go of bytes before ``before``, once they are worth a copy."""
        cut = before - self.start
        if cut >= BLOCK or cut > len(self.data):
            self.data, self.start = self.data[cut:], before

    def find(self, at: int, stop: int) -> int:
        """Place of the first magic that starts in [at, stop), or -1."""
        while at < stop:
            self.drop(at)
            self.upto(min(at + BLOCK, stop) + len(MAGIC) - 1)
            found = self.data.find(MAGIC, at - self.start)
            if found >= 0:
                return self.start + found if self.start + found < stop else -1
            at = max(at + 1, self.start + len(self.data) - len(MAGIC) + 1)
        return -1


def inflate(window: Window, at: int) -> tuple[bytes, int] | None:
    """(record, end) of the gzip member at ``at``; None if no record starts there."""
    unpack, out, pos, checked = zlib.decompressobj(31), [], at, False
    try:
        while not unpack.eof:
            if pos >= window.size:
                return None
            window.upto(pos + 65536)
            piece = window.data[pos - window.start:pos - window.start + 65536]
            out.append(unpack.decompress(piece))
            pos += len(piece)
            if not checked and sum(map(len, out)) >= len(VERSION):
                checked = True
                if not b"".join(out).startswith(b"WARC/1."):
                    return None
            if checked and not unpack.eof:
                window.drop(pos)
    except zlib.error:
        return None
    return (b"".join(out), pos - len(unpack.unused_data)) if checked else None


def records_of(path: str, size: int, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """(place, record) of every record that starts in [start, stop)."""
    fsys, name = file_system(path)
    with fsys.open_input_file(name) as stream:
        window, at = Window(stream, size, start), start
        while True:
            at = window.find(at, stop)
            if at < 0:
                return
            got = inflate(window, at)
            if got is not None:
                yield at, got[0]
                at = got[1]
            else:
                at += 1
                if window.start > at:  # a broken record: look again from its inside
                    window = Window(stream, size, at)


def parse(data: bytes) -> dict:
    """Headers (lower-case names) of a record, with its HTTP header and payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    fields = {k.lower(): v for k, v in fields.items()}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    lines = dict(x.split(": ", 1) for x in http.decode("utf-8").split("\r\n")[1:])
    return {**fields, "payload": payload, "http_length": int(lines["Content-Length"])}


READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                  ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                  ("refers_to", pa.int64()), ("path", pa.string()), ("offset", pa.int64()),
                  ("payload", pa.binary())])


def read_archives(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Every record of the archives of ``manifest`` (path, bytes), with its place.

    Columns: page_id, url, record_type, payload_bytes and payload_digest (of the
    full payload, also for revisits), refers_to, path, offset, payload (empty for
    revisits). A response whose bytes do not match its digest raises.
    """
    ranges = (manifest.select("path", "bytes", F.explode(F.sequence(
        F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)),
        F.lit(split_bytes).cast("long"))).alias("start"))
        .withColumn("stop", F.least("bytes", F.col("start") + split_bytes)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start, stop in zip(*(c.to_pylist() for c in batch.columns)):
                out, held = [], 0
                for at, data in records_of(path, size, start, stop):
                    r = parse(data)
                    digest = r["warc-payload-digest"].removeprefix("sha1:")
                    if r["warc-type"] == "response" and digest_of(r["payload"]) != digest:
                        raise ValueError(f"digest mismatch in {path} at {at}")
                    page, refers = r.get("x-page-id"), r.get("x-refers-to-page-id")
                    out.append((page and int(page), r["warc-target-uri"], r["warc-type"],
                                r["http_length"], digest, refers and int(refers), path, at,
                                r["payload"]))
                    held += len(r["payload"])
                    if held > 8 * 2**20:
                        yield batch_of(READ, **dict(zip(READ.names, zip(*out))))
                        out, held = [], 0
                if out:
                    yield batch_of(READ, **dict(zip(READ.names, zip(*out))))

    # One task per range: by number, as adaptive execution would join such small rows.
    return (ranges.repartition(max(1, ranges.count())).mapInArrow(
        run, "page_id long, url string, record_type string, payload_bytes long, "
        "payload_digest string, refers_to long, path string, offset long, payload binary"))
