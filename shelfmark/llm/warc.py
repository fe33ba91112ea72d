"""WARC archives with a two-level capture index.

Writing. Every task writes gzip-per-record WARC files of its own, under names
that no other attempt uses, and returns one capture row a record: key, file,
offset and length. Of records with equal payloads, one is a response and the
others are revisits that refer to it.

Index. Capture rows are sorted by key, the URL with its host reversed followed by
the page number, and cut into gzip-compressed blocks of lines. The directory has
one row a block: its first key, file, offset and length. Blocks grow with the
corpus so that there are never more than ``DIRECTORY_ROWS`` of them, which
bounds the directory that travels with the tasks.

Lookup. A key is found by binary search in the directory, a range read of one
block, and a range read of each capture's record. Keys are looked up in sorted
order, so a task reads each block once.

Files are reached through the file system that the shared folder's URI names.

Cases: a null html is an empty payload; a null or malformed URL is a key of its own;
rows that repeat a page_id are records of their own, and those that share the
smallest page_id of a payload are all responses; a null page_id is never the
smallest; an empty table gives an empty archive and index.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.plans.shared import new_path, shared_table

REVISIT_FROM = 100
BLOCK_LINES = 2000
DIRECTORY_ROWS = 1 << 16
FILE_BYTES = 1 << 28
#: Characters of a first key that the directory keeps.
KEY_CHARS = 256
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CAPTURE = "key string, page_id long, digest string, kind string, file string, offset long, length long"
_RECORD = "key string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def surt(url: str | None) -> str:
    """``http://m.a.org:80/b?c`` as ``org,a,m:80)/b?c``; scheme, user and fragment do not count."""
    url = (url or "").strip()
    try:
        parts = urlsplit(url if "//" in url else f"//{url}")
        host = (parts.hostname or "").rstrip(".")
        port = f":{parts.port}" if parts.port else ""
    except ValueError:
        return quote(url, safe="/:?&=%,;@[]()!$'*+~#")
    name = ",".join(reversed(host.split("."))) + port
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return quote(f"{name}){path}", safe="/:?&=%,;@[]()!$'*+~#")


def capture_key(url: str | None, page_id: int | None) -> str:
    """Unique but for repeated rows; negative numbers sort among themselves."""
    return f"{surt(url)} {'-' if page_id is None else f'{page_id + (1 << 63):020d}'}"


def _fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def _record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = lambda p: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{p}:{digest}')}>"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {name(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url or '', safe='/:?&=%,;@[]()!$+*~#' + chr(39))}",
        f"WARC-Payload-Digest: sha256:{digest}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {name(refers_to)}", f"Refers-To-Page: {refers_to}"] if revisit else []),
        *([f"Page-ID: {page_id}"] if page_id is not None else []),
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Headers (lower-case names) and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    block = rest[: int(headers["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in http.decode().split("\r\n")[1:])}
    return {"headers": headers, "http": fields, "payload": payload}


def _unique_sink(fs: pafs.FileSystem, folder: str, kind: str):
    name = f"{kind}-{uuid.uuid4().hex}.gz"
    return name, fs.open_output_stream(f"{folder}/{name}", compression=None)


def write_archives(pages: DataFrame, root: str, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Write pages(page_id, url, html) under ``root/warc``; the capture rows, as a written table."""
    body = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", body.alias("html"), F.sha2(body, 256).alias("digest"), F.octet_length(body).alias("size"))
    firsts = (
        rows.filter(F.col("size") >= revisit_from).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1").select("digest", "first")
    )
    joined = rows.join(shared_table(firsts, "firsts"), "digest", "left")
    refers = F.when(F.coalesce(F.col("page_id") != F.col("first"), F.col("first").isNotNull()), F.col("first"))
    fs, base = _fs(root)
    fs.create_dir(f"{base}/warc", recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _fs(root)
        sink, name, at = None, "", 0
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "html", "digest", "refers_to")), strict=True):
                page_id, url, html, digest, refers_to = (x.as_py() for x in row)
                if sink is None or at >= FILE_BYTES:
                    if sink is not None:
                        sink.close()
                    (name, sink), at = _unique_sink(fs, f"{base}/warc", "pages"), 0
                member = gzip.compress(_record(page_id, url, html.encode(), digest, refers_to), 6, mtime=0)
                sink.write(member)
                out.append((capture_key(url, page_id), page_id, digest, "response" if refers_to is None else "revisit", name, at, len(member)))
                at += len(member)
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)],
                    ["key", "page_id", "digest", "kind", "file", "offset", "length"],
                )
        if sink is not None:
            sink.close()

    return shared_table(joined.select("page_id", "url", "html", "digest", refers.alias("refers_to")).mapInArrow(run, _CAPTURE), "captures")


def build_index(captures: DataFrame, root: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write compressed blocks of sorted captures under ``root/index``; the directory, as a written table."""
    n = captures.count()
    lines_a_block = max(block_lines, math.ceil(n / (DIRECTORY_ROWS // 2)))
    parts = max(1, min(DIRECTORY_ROWS // 2, math.ceil(n / (8 * lines_a_block))))
    fs, base = _fs(root)
    fs.create_dir(f"{base}/index", recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _fs(root)
        sink, name, at, lines, first, out = None, "", 0, [], "", []

        def flush():
            nonlocal at, lines
            member = gzip.compress("\n".join(lines).encode(), 6, mtime=0)
            sink.write(member)
            out.append((first[:KEY_CHARS], name, at, len(member), len(lines)))
            at, lines = at + len(member), []

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "digest", "kind", "file", "offset", "length")), strict=True):
                if sink is None:
                    name, sink = _unique_sink(fs, f"{base}/index", "block")
                if not lines:
                    first = row[0]
                lines.append("\t".join(map(str, row)))
                if len(lines) >= lines_a_block:
                    flush()
        if lines:
            flush()
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                ["first_key", "file", "offset", "length", "lines"],
            )

    ordered = captures.repartitionByRange(parts, "key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    return shared_table(ordered.mapInArrow(run, "first_key string, file string, offset long, length long, lines long"), "directory")


class Directory:
    """The sparse directory in memory, and range reads of what it points to."""

    def __init__(self, root: str, rows: list[tuple]):
        self.root = root
        self.rows = sorted(rows)
        self.keys = [r[0] for r in self.rows]

    @classmethod
    def load(cls, root: str, directory: DataFrame) -> Directory:
        got = directory.select("first_key", "file", "offset", "length").toArrow()  # at most DIRECTORY_ROWS
        return cls(root, list(zip(*(got.column(c).to_pylist() for c in got.column_names), strict=True)) if got.num_rows else [])

    def blocks(self, key: str) -> range:
        """The blocks that can hold a key: the last that begins under it, and all that begin with what is kept of it."""
        short = key[:KEY_CHARS]
        return range(max(bisect.bisect_left(self.keys, short) - 1, 0), bisect.bisect_right(self.keys, short))

    def lines(self, block: int, reader: Reader) -> dict[str, list[list[str]]]:
        _, file, offset, length = self.rows[block]
        out: dict[str, list[list[str]]] = {}
        for line in gzip.decompress(reader.read(f"index/{file}", offset, length)).decode().split("\n"):
            key, *rest = line.split("\t")
            out.setdefault(key, []).append(rest)
        return out


class Reader:
    """Range reads through a small pool of open files."""

    def __init__(self, root: str, most: int = 32):
        self.fs, self.base = _fs(root)
        self.most, self.open = most, {}

    def read(self, file: str, offset: int, length: int) -> bytes:
        f = self.open.pop(file, None)
        if f is None:
            if len(self.open) >= self.most:
                self.open.pop(next(iter(self.open))).close()
            f = self.fs.open_input_file(f"{self.base}/{file}")
        self.open[file] = f
        return f.read_at(length, offset)


def read_capture(reader: Reader, capture: list[str]) -> dict:
    """The record that a capture line points to; its payload is checked against the digest."""
    digest, kind, file, offset, length = capture
    record = parse_record(zlib.decompress(reader.read(f"warc/{file}", int(offset), int(length)), 31))
    if kind == "response" and hashlib.sha256(record["payload"]).hexdigest() != digest:
        raise ValueError(f"damaged record at {file}:{offset}")
    return record


def lookup(keys: DataFrame, root: str, directory: DataFrame) -> DataFrame:
    """The records of every distinct key of keys(key)."""
    spark = keys.sparkSession
    shared = spark.sparkContext.broadcast(Directory.load(root, directory).rows)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Directory(root, shared.value)
        for batch in batches:
            names = batch.column("key").to_pylist()
            hits = [(k, b) for k in names for b in index.blocks(k)]
            yield pa.RecordBatch.from_arrays([pa.array([h[0] for h in hits], pa.string()), pa.array([h[1] for h in hits], pa.int32())], ["key", "block"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, reader, block, lines = Directory(root, shared.value), Reader(root), -1, {}
        for batch in batches:
            out: list[tuple] = []
            for key, at in zip(batch.column("key").to_pylist(), batch.column("block").to_pylist(), strict=True):
                if at != block:
                    block, lines = at, index.lines(at, reader)
                for capture in lines.get(key, ()):
                    r = read_capture(reader, capture)
                    h = r["headers"]
                    page, refers = h.get("page-id"), h.get("refers-to-page")
                    out.append((key, page and int(page), int(r["http"]["content-length"]), h["warc-payload-digest"].partition(":")[2], h["warc-type"], refers and int(refers)))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)],
                    ["key", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
                )

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = keys.distinct().mapInArrow(find, "key string, block int")
    return found.repartitionByRange(parts, "block", "key").sortWithinPartitions("block", "key").mapInArrow(read, _RECORD)


def page_keys(pages: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [capture_key(u, p) for u, p in zip(batch.column("url").to_pylist(), batch.column("page_id").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string())], ["key"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url").mapInArrow(run, "key string")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages, index the archives, and read every capture back through the index."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    root = new_path(spark, "archive")
    directory = build_index(write_archives(pages, root), root)
    return lookup(page_keys(pages), root, directory).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (SELECT payload_digest, min(page_id) AS first FROM p GROUP BY 1)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM p JOIN f USING (payload_digest)
"""
