"""WARC archives with a two-level capture index.

Archive: one gzip member per record (WARC/1.1).  Of records with equal
payloads the one with the smallest page id holds it (``response``), the others
refer to it (``revisit``, identical-payload-digest profile).

Index: captures are sorted by reversed-host URL key, cut into blocks of
``block_captures`` lines and compressed block by block.  A shard of the index
holds one key range: its blocks, then the sparse directory (each block's first
key and place), then the directory's place.  The first level is one row per
shard.  A lookup finds the shard, searches its directory by bisection, and
reads only the blocks that can hold the key.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.store import bounded_batches, create, new_file, open_random, shared_folder, table

DEFAULT_BLOCK_CAPTURES, DEFAULT_DATE, _MAGIC = 500, "2024-01-01T00:00:00Z", b"RFCDX1\0\0"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = "key string, url string, page_id long, file string, offset long, length long"


def url_key(url: str | None) -> str:
    """Host labels in reverse order, port, path and query, in lower case:
    ``https://blog.example.org:8080/A?b`` gives ``org,example,blog:8080)/a?b``.
    Null gives the empty key; a URL without host keeps its text."""
    text = (url or "").strip()
    try:
        parts = urlsplit(text)
        host, port = parts.hostname, parts.port
    except ValueError:
        host = None
    if not host:
        return text.lower()
    labels = host.split(".")
    if len(labels) > 1 and labels[0] == "www":
        labels = labels[1:]
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return (",".join(reversed(labels)) + (f":{port}" if port else "") + ")" + rest).lower()


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ------------------------------------------------------------------ records
def _record(kind: str, url: str | None, page_id: int | None, payload: bytes, digest: str, date: str, refers: int | None, size: int) -> bytes:
    """One record, compressed.  JSON escapes keep line breaks in a URL out of
    the header."""
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {kind} {url}")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Date: {date}",
             f"WARC-Target-URI: {json.dumps(url)[1:-1] if url is not None else ''}", f"WARC-Payload-Digest: sha1:{digest}",
             f"X-Page-ID: {'' if page_id is None else page_id}", f"X-Payload-Length: {size}"]
    if url is None:
        lines.append("X-No-URL: 1")
    if kind == "revisit":
        lines += [f"WARC-Profile: {_PROFILE}", f"X-Refers-To-Page-ID: {'' if refers is None else refers}"]
    body = b"" if kind == "revisit" else b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size + payload
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(body)}"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n", compresslevel=4, mtime=0)


def parse_record(packed: bytes) -> dict:
    """Headers (names as written) and ``payload`` of one compressed record."""
    data = gzip.decompress(packed)
    head, _, body = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError("not a WARC record")
    record = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    body = body[:int(record["Content-Length"])]
    record["payload"] = body.partition(b"\r\n\r\n")[2] if record["WARC-Type"] == "response" else b""
    return record


def mark_revisits(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """``(page_id, url, html, _first, _copies)``: the smallest page id of equal
    payloads.  Contents are compared by SHA-256 and length.  The groups are
    written before they are joined, so that Spark can split a group that very
    many pages share."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html",
                         F.octet_length(F.coalesce("html", F.lit(""))).alias("_size"), F.unhex(F.sha2(payload, 256)).alias("_key"))
    groups = table(keyed.where(F.col("_size") >= min_payload).groupBy("_size", "_key")
                   .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_copies")).where("_copies > 1"), "equal-payloads")
    return keyed.join(groups, ["_size", "_key"], "left").select("page_id", "url", "html", "_first", "_copies")


def write_archive(pages: DataFrame, folder: str | None = None, min_payload: int = 0, date: str = DEFAULT_DATE) -> DataFrame:
    """Write a record per page; returns the captures ``(key, url, page_id,
    file, offset, length)``.

    Null html is an empty payload; null urls and page ids are kept as null.
    Equal payloads of at least ``min_payload`` bytes are written once, with the
    smallest page id; rows that repeat that id are all responses, and where all
    ids are null so are all records.  An empty table writes nothing.  Columns
    other than page_id, url and html are not read.
    """
    bounded_batches(pages.sparkSession)
    folder = folder or shared_folder(pages.sparkSession, "warc")
    schema = pa.schema([("key", pa.string()), ("url", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, at = new_file(folder, ".warc.gz"), None, 0
        for batch in batches:
            rows = []
            for page_id, url, html, first, copies in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "_first", "_copies"))):
                out = out or create(path)
                payload = (html or "").encode("utf-8")
                kind = "revisit" if copies is not None and page_id != first else "response"
                packed = _record(kind, url, page_id, payload, payload_digest(payload), date, first, len(payload))
                out.write(packed)
                rows.append((url_key(url), url, page_id, path, at, len(packed)))
                at += len(packed)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        if out:
            out.close()

    return table(mark_revisits(pages, min_payload).mapInArrow(write, CAPTURE), "captures")


# ------------------------------------------------------------------ index
def build_index(captures: DataFrame, folder: str | None = None, block_captures: int = DEFAULT_BLOCK_CAPTURES) -> DataFrame:
    """Sort the captures by key (then page id, file and offset) and write the
    index; returns the shards ``(shard, path, first, last, captures)``."""
    folder = folder or shared_folder(captures.sparkSession, "index")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, at, lines, directory, n = new_file(folder, ".cdx"), None, 0, [], [], 0
        first = last = None

        def block() -> None:
            nonlocal at, lines
            packed = zlib.compress("\n".join(json.dumps(x) for x in lines).encode(), 6)
            directory.append([lines[0][0], at, len(packed)])
            out.write(packed)
            at, lines = at + len(packed), []

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "url", "page_id", "file", "offset", "length"))):
                out = out or create(path)
                first, last, n = row[0] if first is None else first, row[0], n + 1
                lines.append(row)
                if len(lines) == block_captures:
                    block()
        if out:
            if lines:
                block()
            packed = zlib.compress(json.dumps(directory).encode(), 6)
            out.write(packed + struct.pack("<qq", at, len(packed)) + _MAGIC)
            out.close()
            yield pa.RecordBatch.from_pydict({"shard": [TaskContext.get().partitionId()], "path": [path], "first": [first], "last": [last], "captures": [n]})

    order = ["key", "page_id", "file", "offset"]
    ordered = captures.select("key", "url", "page_id", "file", "offset", "length").repartitionByRange(*order).sortWithinPartitions(*order)
    return table(ordered.mapInArrow(write, "shard long, path string, first string, last string, captures long"), "index-shards")


class IndexShard:
    """Bisects the directory of one shard and reads single blocks."""

    def __init__(self, path: str):
        self.file = open_random(path)
        size = self.file.size()
        at, length = struct.unpack("<qq", self.file.read_at(16, size - 24))
        if self.file.read_at(8, size - 8) != _MAGIC:
            raise ValueError(f"{path}: not an index shard")
        self.directory = json.loads(zlib.decompress(self.file.read_at(length, at)))
        self.first = [d[0] for d in self.directory]
        self.kept: tuple[int, list] = (-1, [])

    def block(self, k: int) -> list:
        if self.kept[0] != k:
            _, at, length = self.directory[k]
            self.kept = (k, [json.loads(x) for x in zlib.decompress(self.file.read_at(length, at)).decode().split("\n")])
        return self.kept[1]

    def find(self, key: str) -> Iterator[list]:
        """Captures of ``key``: from the last block that starts before it on."""
        for k in range(max(0, bisect_left(self.first, key) - 1), bisect_right(self.first, key)):
            lines = self.block(k)
            lo = bisect_left(lines, key, key=lambda x: x[0])
            while lo < len(lines) and lines[lo][0] == key:
                yield lines[lo]
                lo += 1


def lookup(index: DataFrame, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """All captures of the keys of ``urls``, once each: ``(key, url, page_id,
    file, offset, length)``; keys without captures give none.

    Each wanted key is routed by bisection to the shards whose range holds it (a
    key on a border, or one that fills several shards, to each of them); every
    task then searches its shards one after the other with sorted keys."""
    schema = pa.schema([("key", pa.string()), ("url", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
    shards = [(r.path, r["first"], r["last"]) for r in index.orderBy("shard").collect()]  # the top level: a row a shard
    firsts, lasts = [s[1] for s in shards], [s[2] for s in shards]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = sorted({url_key(u) for u in batch.column(0).to_pylist()})
            pairs = [(s, k) for k in keys for s in range(bisect_left(lasts, k), bisect_right(firsts, k))]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.string())], ["shard", "key"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = (-1, None)
        for batch in batches:
            rows = []
            for s, key in zip(batch.column("shard").to_pylist(), batch.column("key").to_pylist()):
                if opened[0] != s:
                    opened = (s, IndexShard(shards[s][0]))
                rows += opened[1].find(key)
                if len(rows) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    wanted = urls.select(F.col(url_col).cast("string")).mapInArrow(route, "shard long, key string").distinct()
    return wanted.repartitionByRange("shard", "key").sortWithinPartitions("shard", "key").mapInArrow(search, CAPTURE)


# ------------------------------------------------------------------ reading
def read_records(captures: DataFrame, gap: int = 65_536, most: int = 8_000_000, payloads: bool = True) -> DataFrame:
    """Read the records of ``captures`` by ranges: ``(page_id, url,
    record_type, refers_to, payload_digest, payload_bytes, payload)``.

    Captures are brought together by file and offset; ranges that lie at most
    ``gap`` bytes apart are read at once, up to ``most`` bytes.  A payload
    whose SHA-1 is not the stated one raises.  ``payload`` is null for revisits,
    and without ``payloads`` for all."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])

    def parsed(packed: bytes) -> tuple:
        r = parse_record(packed)
        digest = r["WARC-Payload-Digest"].removeprefix("sha1:")
        response = r["WARC-Type"] == "response"
        if response and payload_digest(r["payload"]) != digest:
            raise ValueError(f"record {r['WARC-Record-ID']}: the payload does not have its digest")
        number = lambda name: int(r[name]) if r.get(name) else None
        url = None if "X-No-URL" in r else json.loads(f'"{r["WARC-Target-URI"]}"')
        return (number("X-Page-ID"), url, r["WARC-Type"], number("X-Refers-To-Page-ID"), digest, int(r["X-Payload-Length"]), r["payload"] if response and payloads else None)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = (None, None)
        for batch in batches:
            spans = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))))
            i = 0
            while i < len(spans):
                path, start, length = spans[i]
                j, end = i + 1, start + length
                while j < len(spans) and spans[j][0] == path and 0 <= spans[j][1] - end <= gap and spans[j][1] + spans[j][2] - start <= most:
                    end = spans[j][1] + spans[j][2]
                    j += 1
                if opened[0] != path:
                    opened = (path, open_random(path))
                data = opened[1].read_at(end - start, start)
                rows = [parsed(data[o - start:o - start + n]) for _, o, n in spans[i:j]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                i = j

    return (captures.select("file", "offset", "length").repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
            .mapInArrow(read, "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"))
