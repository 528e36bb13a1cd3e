"""WARC archives with a two-level capture index.

Pages are written as WARC records, a gzip member each, into archive files in the
shared folder; a payload that another page holds too is written once and
revisited by the others.  The captures are then sorted by reversed-host URL key
(``com,example)/path``) and their lines compressed in blocks of a thousand;
a sparse directory has one fixed-size entry for each block: its first key, and
where the block is.  Each task of the sort writes its own stretch of the directory;
the driver only lists these stretches.  A capture is found by binary search in the
directory, which reads a handful of entries and never the whole, then by reading
one block and one range of an archive.
"""

from __future__ import annotations

import base64
import bisect
import dataclasses
import hashlib
import itertools
import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm.common import hash_bucket, scratch_path, written

#: Captures in a block of the index.
BLOCK_LINES = 1024
#: Bytes of the key that a directory entry holds; longer keys go on in the block.
KEY_BYTES = 80
_ENTRY = struct.Struct(f">{KEY_BYTES}sQI")  # start of the first key, offset, bytes
ENTRY_BYTES = _ENTRY.size
_WHEN = "2024-01-01T00:00:00Z"  # records carry no time of their own in the table


def url_key(url: str | None) -> str:
    """The URL with its host reversed: ``http://a.b.org:80/p?q`` is ``org,b,a:80)/p?q``; null is empty."""
    if not url:
        return ""
    try:
        parts = urlsplit(url)
        host, _, port = parts.netloc.rpartition("@")[2].partition(":")
    except ValueError:
        return url
    if not host:
        return url
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "") + (f"#{parts.fragment}" if parts.fragment else "")
    return ",".join(reversed(host.lower().split("."))) + (f":{port}" if port else "") + ")" + rest


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record: the response, or a revisit of the page ``refers_to``, whose HTTP head it keeps."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "urn:none")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {target}')}>",
        f"WARC-Date: {_WHEN}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"X-Page-ID: {'' if page_id is None else page_id}",
    ]
    block = http
    if refers_to is None:
        block += payload
    else:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields (lower-cased names), the HTTP head and the payload of an uncompressed record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, http, payload


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class Store:
    """Files under a URI of the shared folder, by whatever file system its scheme names."""

    def __init__(self, base: str):
        self.fs, self.root = pafs.FileSystem.from_uri(base if "://" in base or base.startswith("file:") else "file://" + os.path.abspath(base))
        self.open_files: dict[str, pa.NativeFile] = {}

    def write(self, name: str):
        path = f"{self.root}/{name}"
        self.fs.create_dir(os.path.dirname(path), recursive=True)
        return self.fs.open_output_stream(path, compression=None)

    def size(self, name: str) -> int:
        return self.fs.get_file_info(f"{self.root}/{name}").size

    def read(self, name: str, offset: int, length: int) -> bytes:
        f = self.open_files.get(name)
        if f is None:
            if len(self.open_files) > 64:
                self.close()
            f = self.open_files[name] = self.fs.open_input_file(f"{self.root}/{name}")
        f.seek(offset)
        return f.read(length)

    def close(self) -> None:
        for f in self.open_files.values():
            f.close()
        self.open_files.clear()


@dataclasses.dataclass
class Archive:
    """Where the archive is, and its table of captures (key, page_id, file, offset, length)."""

    base: str
    captures: DataFrame
    blocks: int


#: Pages of one part of a group of equal payloads, at most about; beyond the least number of parts there are as many as that takes.
PART_PAGES = 100_000


def decide_revisits(pages: DataFrame, least_bytes: int) -> DataFrame:
    """page_id, url, html and refers_to: of equal payloads the largest page_id is the response.

    Equal payloads are reduced in 64 parts or more first and the answer goes back to
    each part, so a payload that many pages share is never in one task.
    """
    salts = max(64, -(-pages.count() // PART_PAGES))
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.unhex(F.sha1(html.cast("binary"))).alias("d"), hash_bucket("page_id", salts).alias("salt"))
    parts = rows.groupBy("d", "salt").agg(F.max("page_id").alias("last"), F.max(F.octet_length("html")).alias("n"))
    whole = parts.groupBy("d").agg(F.max("last").alias("top"), F.max("n").alias("n")).filter(F.col("n") >= least_bytes)
    known = parts.select("d", "salt").join(whole, "d")
    return rows.join(known, ["d", "salt"], "left").select(
        "page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("top")) & F.col("top").isNotNull(), F.col("top")).alias("refers_to")
    )


def write_archive(pages: DataFrame, least_bytes: int = 0) -> Archive:
    """Write a record for each row (page_id, url, html) and index them.

    Null html is an empty payload, a null url has the empty key.  Files are named by
    partition and attempt, and only those that the captures name count, so a task
    that is run again does no harm.
    """
    spark = pages.sparkSession
    base = scratch_path(spark, "warc")
    decided = decide_revisits(pages, least_bytes)
    schema = "key string, page_id long, file string, offset long, length long"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, out, at = Store(base), None, 0
        name = f"archive/{uuid.uuid4().hex}.warc.gz"
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if out is None:
                    out = store.write(name)
                data = _member(record(r["page_id"], r["url"], r["html"].encode(), r["refers_to"]))
                out.write(data)
                rows.append({"key": url_key(r["url"]), "page_id": r["page_id"], "file": name, "offset": at, "length": len(data)})
                at += len(data)
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]))
        if out is not None:
            out.close()

    captures = written(decided.withColumn("page_id", F.col("page_id").cast("long")).mapInArrow(write, schema), "captures")
    return Archive(base, captures, _index(spark, base, captures))


def directory_entry(first_key: str, offset: int, length: int) -> bytes:
    return _ENTRY.pack(first_key.encode()[:KEY_BYTES], offset, length)


def _index(spark: SparkSession, base: str, captures: DataFrame) -> int:
    """Sort the captures into compressed blocks and write the directory; returns the number of blocks."""
    wide = captures.select(F.col("key").cast("binary").alias("k"), "key", "page_id", "file", "offset", "length")
    ordered = wide.repartitionByRange("k", "page_id").sortWithinPartitions("k", "page_id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, out, at, entries = Store(base), None, 0, bytearray()
        name = uuid.uuid4().hex
        lines: list[tuple] = []

        def flush() -> None:
            nonlocal at, lines
            data = zlib.compress("\n".join(json.dumps(x) for x in lines).encode(), 3)
            out.write(data)
            entries.extend(directory_entry(lines[0][0], at, len(data)))
            at, lines = at + len(data), []

        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    out = store.write(f"index/{name}")
                lines.append((r["key"], r["page_id"], r["file"], r["offset"], r["length"]))
                if len(lines) == BLOCK_LINES:
                    flush()
        if lines:
            flush()
        if out is not None:
            out.close()
            with store.write(f"directory/{name}") as f:
                f.write(bytes(entries))
            yield pa.RecordBatch.from_pylist([{"nth": TaskContext.get().partitionId(), "name": name, "blocks": len(entries) // ENTRY_BYTES}])

    stretches = written(ordered.mapInArrow(write, "nth long, name string, blocks long"), "stretches")
    held = sorted(tuple(r) for r in stretches.collect())  # one for each task of the sort, in the order of keys
    with Store(base).write("stretches") as out:
        out.write("".join(f"{name} {n}\n" for _, name, n in held).encode())
    return sum(n for _, _, n in held)


class Reader:
    """Finds captures of one archive; for use in a task."""

    def __init__(self, base: str, blocks: int):
        self.store, self.blocks = Store(base), blocks
        listed = [x.split() for x in self.store.read("stretches", 0, self.store.size("stretches")).decode().splitlines()]
        self.names = [name for name, _ in listed]
        self.ends = list(itertools.accumulate(int(n) for _, n in listed))
        self.entries: dict[int, tuple[str, bytes, int, int]] = {}
        self.block_at = -1
        self.lines: list[list] = []

    def entry(self, i: int) -> tuple[str, bytes, int, int]:
        """Name of the stretch, start of the first key, offset and bytes of block ``i``."""
        got = self.entries.get(i)
        if got is None:
            part = bisect.bisect_right(self.ends, i)
            nth = i - (self.ends[part - 1] if part else 0)
            key, offset, length = _ENTRY.unpack(self.store.read(f"directory/{self.names[part]}", nth * _ENTRY.size, _ENTRY.size))
            if len(self.entries) > 100_000:
                self.entries.clear()
            got = self.entries[i] = self.names[part], key.rstrip(b"\0"), offset, length
        return got

    def first_block(self, key: bytes) -> int:
        """The first block that may hold ``key``: the last whose first key, as far as it is kept, is less, or block 0."""
        key = key[:KEY_BYTES].rstrip(b"\0")
        low, high = 0, self.blocks
        while low < high:
            mid = (low + high) // 2
            if self.entry(mid)[1] < key:
                low = mid + 1
            else:
                high = mid
        return max(0, low - 1)

    def block(self, i: int) -> list[list]:
        if i != self.block_at:
            name, _, offset, length = self.entry(i)
            self.lines = [json.loads(x) for x in zlib.decompress(self.store.read(f"index/{name}", offset, length)).decode().split("\n")]
            self.block_at = i
        return self.lines

    def blocks_of(self, key: str) -> Iterator[int]:
        """The blocks that may hold ``key``."""
        wanted = key.encode()
        for i in range(self.first_block(wanted), self.blocks):
            if self.entry(i)[1] > wanted[:KEY_BYTES]:
                return
            yield i

    def fetch(self, file: str, offset: int, length: int) -> tuple[dict[str, str], bytes, bytes]:
        return parse_record(zlib.decompress(self.store.read(file, offset, length), 31))


def _described(fields: dict[str, str], http: bytes, payload: bytes) -> dict:
    kind = fields["warc-type"]
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response":
        if digest_of(payload) != digest:
            raise ValueError("payload does not match its digest")
        size = len(payload)
    else:
        size = int(re.search(rb"(?im)^content-length: *(\d+)", http)[1])
    return {
        "page_id": int(fields["x-page-id"]) if fields["x-page-id"] else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": int(fields["x-refers-to-page"]) if kind == "revisit" else None,
    }


_READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
_READ_SQL = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


#: Blocks that one task reads, about.
TASK_BLOCKS = 8
#: Rows that a task gathers before it passes them on.
HELD_ROWS = 2_000


def _found(archive: Archive, asked: DataFrame) -> DataFrame:
    """The captures of each row of ``asked`` (key, url), each row once: url and the columns of :func:`read_back`.

    Keys are searched for in the directory first; that names blocks, each of a fixed
    size, which are then read with the ranges of the archives that their lines name.
    So a key that many captures share is the work of many tasks.
    """
    base, blocks = archive.base, archive.blocks

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(base, blocks)
        for batch in batches:
            rows = ((i, k, u) for k, u in zip(*(c.to_pylist() for c in batch.columns), strict=True) for i in reader.blocks_of(k))
            while part := list(itertools.islice(rows, 10_000)):
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int64()), *(pa.array([r[n] for r in part], pa.string()) for n in (1, 2))], ["block", "key", "url"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(base, blocks)
        schema = pa.schema([("url", pa.string()), *_READ])
        held: list[dict] = []
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for i, wanted in itertools.groupby(rows, lambda r: r[0]):
            urls: dict[str, list] = {}
            for _, key, url in wanted:
                urls.setdefault(key, []).append(url)
            for line in sorted((x for x in reader.block(i) if x[0] in urls), key=lambda x: (x[2], x[3])):
                got = _described(*reader.fetch(*line[2:]))
                held += [{"url": u, **got} for u in urls[line[0]]]
                if len(held) >= HELD_ROWS:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held = []
        yield pa.RecordBatch.from_pylist(held, schema)

    located = asked.select("key", "url").distinct().sortWithinPartitions("key").mapInArrow(locate, "block long, key string, url string")
    dealt = located.repartition(max(1, -(-blocks // TASK_BLOCKS)), F.floor(F.col("block") / TASK_BLOCKS)).sortWithinPartitions("block")
    return dealt.mapInArrow(read, f"url string, {_READ_SQL}")


def _keys(urls: DataFrame, url_col: str) -> DataFrame:
    """Key and URL of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in batch.column(0).to_pylist()], pa.string()), batch.column(0).cast(pa.string())], ["key", "url"])

    return urls.select(F.col(url_col).cast("string").alias("url")).mapInArrow(run, "key string, url string")


def read_back(archive: Archive, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """The records of all pages whose keys ``urls`` has, found through the index.

    Returns page_id, payload_bytes, payload_digest, record_type and refers_to, one row
    for each record however often its URL is asked for.
    """
    return _found(archive, _keys(urls, url_col).select("key", F.lit(None).cast("string").alias("url"))).drop("url")


def lookup(archive: Archive, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """The captures of each distinct URL asked for: url and the columns of :func:`read_back`."""
    return _found(archive, _keys(urls, url_col))


def archive_pages(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write all rows of ``pages`` to archives and look every page's URL up in them; one row for each page.

    Pages of equal payload of at least ``least_bytes`` bytes: that with the largest
    page_id is a response, the others revisit it; a page without id is never the one
    referred to unless all are without, in which case all are responses.  Rows that
    repeat the largest page_id are responses too.  An empty table gives an empty
    result.
    """
    return read_back(write_archive(pages, least_bytes), pages)


ORACLE = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
last AS (SELECT payload, max(page_id) AS top FROM p GROUP BY payload)
SELECT page_id, octet_length(encode(payload)) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to
FROM p JOIN last USING (payload)
"""
