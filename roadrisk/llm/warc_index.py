"""WARC archives with a two-level capture index.

Writing: each task writes one archive of gzip members, one member for each record (WARC/1.1), and
reports (key, page_id, archive, offset, length) of each. Of rows with equal payloads of at least
``min_bytes`` bytes, the one with the largest page_id is a ``response``; the others are ``revisit``
records without the payload that name it. Whether a payload has others is found by a count per
digest; only payloads found more than once are joined back, on a join that Spark can split.

Index: keys are the URL with its host reversed (``http://www.a.org/x?y`` -> ``org,a)/x?y``), then
page_id. Sorted keys are cut into blocks of ``block_lines`` lines, each compressed; an index shard
ends with its sparse directory: first key, offset and length of each block. A lookup bisects the
shards (one row each), then the shard's directory, and reads one block by its range, then the
record by its own range. Nothing whole is loaded: a task holds one directory and one block.

Defined results: a null html is an empty payload; a null url has the empty key; a null page_id is
written as an empty field and read back as null, and sorts below all others; rows that repeat
page_id and payload are told apart by their row number, so one is the response and the others
revisit it; extra columns are left out; an empty table gives no archives and no rows.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import math
import struct
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch, filesystem, small_batches, stored, text_bytes, work_path

MAGIC = b"CAPIDX01"


def surt(url: str | None) -> str:
    """The sort key of a URL: reversed host, then path and query; scheme, ``www.``, port 80 and 443 and fragment go."""
    if not url:
        return ""
    try:
        u = urlsplit(url.strip())
        host, port = (u.hostname or "").removeprefix("www."), u.port
    except ValueError:
        return url
    if not host:
        return url
    at = "" if port in (None, 80, 443) else f":{port}"
    return f"{','.join(reversed(host.split('.')))}{at}){u.path or '/'}" + (f"?{u.query}" if u.query else "")


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, page_id: int | None, row: int, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record. A revisit has no payload but tells its length and digest and what it refers to."""
    body = payload if kind == "response" else b""
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:row:{row}>",
        f"WARC-Target-URI: {json.dumps(url or '')[1:-1]}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Page-ID: {'' if page_id is None else page_id}",
        f"WARC-Payload-Length: {len(payload)}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(body)}",
    ]
    if kind == "revisit":
        head[2:2] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To-Page-ID: {'' if refers_to is None else refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and body of a compressed record."""
    data = zlib.decompress(member, wbits=31)
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
    return fields, rest[: int(fields["Content-Length"])]


def _gzip(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


#: Bytes of archives for each reading task, and of neighbouring records that stay together.
_READ_BYTES, _STRETCH_BYTES = 4 << 20, 1 << 20

CAPTURES = "key string, page_id long, row long, archive string, offset long, length long"
CAPTURE_SCHEMA = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("row", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])


def plan_records(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """page_id, row, url, payload, first_row, refers_to: which record each page becomes."""
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), text_bytes(html_col).alias("payload"))
    # rows are numbered once, on disk, so that every later read sees the same numbers
    p = stored(p.withColumn("row", F.monotonically_increasing_id()).withColumn("digest", F.unhex(F.sha1("payload"))), "pages")
    order = F.struct("page_id", "row")  # null sorts below all
    best = p.where(F.length("payload") >= min_bytes).groupBy("digest").agg(F.max(order).alias("best"), F.count("*").alias("n")).where("n > 1")
    repeated = p.select("digest", "row", "payload", "page_id", "url").join(best.select("digest", F.col("best.row").alias("first_row"), F.col("best.page_id").alias("refers_to")), "digest", "left")
    large = (F.length("payload") >= min_bytes) & F.col("first_row").isNotNull() & (F.col("first_row") != F.col("row"))
    return repeated.select("page_id", "row", "url", "payload", large.alias("revisit"), F.when(large, F.col("refers_to")).alias("refers_to"))


def write_archives(planned: DataFrame, folder: str) -> DataFrame:
    """Writes one archive for each task; returns the captures."""

    def task(batches):
        out, place, name = None, 0, ""
        for b in small_batches(batches):
            if out is None:
                name = f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                fs, at = filesystem(name)
                fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
                out = fs.open_output_stream(at, compression=None)
            found = []
            for page_id, row, url, payload, revisit, refers_to in zip(*(c.to_pylist() for c in b.columns), strict=True):
                data = _gzip(record("revisit" if revisit else "response", page_id, row, url, payload, sha1_base32(payload), refers_to))
                out.write(data)
                found.append((surt(url), page_id, row, name, place, len(data)))
                place += len(data)
            if found:
                yield batch(CAPTURE_SCHEMA, zip(*found, strict=True))
        if out is not None:
            out.close()

    return planned.mapInArrow(task, CAPTURES)


def _line_key(key: str, page_id: int | None, row: int) -> tuple[bytes, int, int]:
    return key.encode(), -(1 << 63) if page_id is None else page_id, row


class IndexWriter:
    """One shard: compressed blocks of sorted lines, then the sparse directory."""

    def __init__(self, path: str, block_lines: int):
        fs, at = filesystem(path)
        fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
        self.out = fs.open_output_stream(at, compression=None)
        self.place, self.block_lines = 0, block_lines
        self.lines: list[list] = []
        self.directory: list[list] = []

    def add(self, line: list) -> None:
        self.lines.append(line)
        if len(self.lines) == self.block_lines:
            self._block()

    def _block(self) -> None:
        data = zlib.compress("\n".join(json.dumps(x) for x in self.lines).encode())
        self.out.write(data)
        self.directory.append([self.lines[0][:3], self.place, len(data)])
        self.place += len(data)
        self.lines = []

    def close(self) -> None:
        if self.lines:
            self._block()
        data = zlib.compress(json.dumps(self.directory).encode())
        self.out.write(data + struct.pack("<QQ", self.place, len(data)) + MAGIC)
        self.out.close()


class IndexReader:
    """Lookups in one shard by bisecting its directory; the block read last is kept."""

    def __init__(self, path: str):
        fs, at = filesystem(path)
        self.file = fs.open_input_file(at)
        tail = self.file.read_at(24, self.file.size() - 24)
        if tail[16:] != MAGIC:
            raise ValueError(f"{path}: not a complete index shard")
        place, n = struct.unpack("<QQ", tail[:16])
        self.directory = json.loads(zlib.decompress(self.file.read_at(n, place)))
        self.firsts = [_line_key(*d[0]) for d in self.directory]
        self.held: tuple[int, list, list] = (-1, [], [])

    def block(self, k: int) -> tuple[list, list]:
        if self.held[0] != k:
            _, place, n = self.directory[k]
            lines = [json.loads(x) for x in zlib.decompress(self.file.read_at(n, place)).split(b"\n")]
            self.held = (k, [_line_key(*x[:3]) for x in lines], lines)
        return self.held[1], self.held[2]

    def find(self, key: str, page_id: int | None, row: int) -> list | None:
        """The line of one capture: key, page_id, row, archive, offset, length."""
        want = _line_key(key, page_id, row)
        k = bisect.bisect_right(self.firsts, want) - 1
        if k < 0:
            return None
        keys, lines = self.block(k)
        i = bisect.bisect_left(keys, want)
        return lines[i] if i < len(keys) and keys[i] == want else None

    def captures(self, key: str) -> Iterator[list]:
        """All captures of a URL key, over as many blocks as they fill."""
        low = (key.encode(), -(1 << 63), -1)
        k = max(0, bisect.bisect_right(self.firsts, low) - 1)
        while k < len(self.directory) and (k == 0 or self.directory[k][0][0].encode() <= key.encode() or self.firsts[k] <= low):
            keys, lines = self.block(k)
            for i in range(bisect.bisect_left(keys, low), len(keys)):
                if lines[i][0] != key:
                    return
                yield lines[i]
            k += 1


SHARDS = pa.schema([("path", pa.string()), ("key", pa.string()), ("page_id", pa.int64()), ("row", pa.int64())])


def write_index(captures: DataFrame, folder: str, block_lines: int = 1000) -> DataFrame:
    """Sorted shards of the captures; returns each shard's path and first line."""

    def task(batches):
        writer = first = None
        for b in small_batches(batches, 4096):
            for line in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if writer is None:
                    path, first = f"{folder}/index-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.cdx", line
                    writer = IndexWriter(path, block_lines)
                writer.add(list(line))
        if writer is not None:
            writer.close()
            yield batch(SHARDS, [[path], *([v] for v in first[:3])])

    ordered = captures.select(*CAPTURE_SCHEMA.names).repartitionByRange("key", "page_id", "row").sortWithinPartitions("key", "page_id", "row")
    return ordered.mapInArrow(task, "path string, key string, page_id long, row long")


FOUND = "key string, page_id long, row long, archive string, offset long, length long"


def look_up(wanted: DataFrame, shards: list[tuple]) -> DataFrame:
    """The capture of each (key, page_id, row) of ``wanted``, by binary search in the index files.

    ``shards`` has one row (path, key, page_id, row) for each shard. Wanted rows are sorted within
    their task, so each block is read about once.
    """
    shards = sorted(shards, key=lambda s: _line_key(*s[1:]))
    firsts, paths = [_line_key(*s[1:]) for s in shards], [s[0] for s in shards]

    def task(batches):
        reader, opened = None, -1
        for b in small_batches(batches, 4096):
            found = []
            for key, page_id, row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                k = bisect.bisect_right(firsts, _line_key(key, page_id, row)) - 1
                if k >= 0 and k != opened:
                    reader, opened = IndexReader(paths[k]), k
                line = reader.find(key, page_id, row) if k >= 0 else None
                found.append(line or [key, page_id, row, None, None, None])
            if found:
                yield batch(CAPTURE_SCHEMA, zip(*found, strict=True))

    ordered = wanted.select("key", "page_id", "row").repartitionByRange("key", "page_id", "row").sortWithinPartitions("key", "page_id", "row")
    return ordered.mapInArrow(task, FOUND)


def read_records(found: DataFrame, n_bytes: int) -> DataFrame:
    """Each found capture's record, by one range read: page_id, payload_bytes, payload_digest, record_type, refers_to.

    ``n_bytes`` of records, as they lie in the archives, decide into how many tasks the reads are dealt.
    """
    out = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def number(x: str | None) -> int | None:
        return int(x) if x else None

    def task(batches):
        file, opened = None, None
        for b in small_batches(batches):
            rows = []
            for archive, offset, length in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if archive != opened:
                    fs, at = filesystem(archive)
                    file, opened = fs.open_input_file(at), archive
                fields, body = parse(file.read_at(length, offset))
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if fields["WARC-Type"] == "response" and sha1_base32(body) != digest:
                    raise ValueError(f"{archive} at {offset}: the payload doesn't have its digest")
                rows.append((number(fields["WARC-Page-ID"]), int(fields["WARC-Payload-Length"]), digest, fields["WARC-Type"], number(fields.get("WARC-Refers-To-Page-ID"))))
            if rows:
                yield batch(out, zip(*rows, strict=True))

    # found captures of one archive lie in many index ranges: deal them out by archive and stretch, then read ahead
    stretch = (F.col("offset") / _STRETCH_BYTES).cast("long")
    ordered = found.where("archive is not null").select("archive", "offset", "length").repartition(max(1, math.ceil(n_bytes / _READ_BYTES)), "archive", stretch).sortWithinPartitions("archive", "offset")
    return ordered.mapInArrow(task, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive(spark: SparkSession, pages: DataFrame, *, min_bytes: int = 0, block_lines: int = 1000, **columns) -> tuple[DataFrame, list[tuple]]:
    """Writes archives and index of ``pages``; the captures and the index's shard table."""
    folder = work_path(spark, "warc")
    captures = stored(write_archives(plan_records(pages, min_bytes=min_bytes, **columns), folder), "captures")
    shards = [tuple(r) for r in write_index(captures, f"{folder}-index", block_lines).collect()]
    return captures, shards


def round_trip(pages: DataFrame, *, min_bytes: int = 0, block_lines: int = 1000, **columns) -> DataFrame:
    """Archives ``pages``, looks every page up in the index and reads its record back."""
    captures, shards = archive(pages.sparkSession, pages, min_bytes=min_bytes, block_lines=block_lines, **columns)
    n_bytes = captures.agg(F.sum("length")).first()[0] or 0
    return read_records(look_up(captures, shards), n_bytes)
