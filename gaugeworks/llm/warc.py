"""WARC archives in seekable Zstandard bundles.

Records are grouped into independent frames; a bundle ends with a seek table in a
skippable frame (frame sizes, their number, and the seekable-format magic).  The
index maps each record to its bundle, its frame and its offset within that frame,
so one record costs one frame.  Of records with equal payloads, that with the
smallest id holds the payload and the others revisit it.

Bundles are written by executors to a folder that all of them share, under a
temporary name first; a repeated task writes the same bundle again.

Defined results: a null payload is empty; payloads under ``min_bytes`` bytes are
never revisited; all rows that carry the smallest id of their payload are responses;
a null id never is the smallest unless all are null, and is written 'null'; line
breaks in urls are percent-encoded; an empty table makes no bundle.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ._store import Workspace

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1  # fixed values of the seekable format
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URN = "urn:gaugeworks:page:"
INDEX_SCHEMA = "page_id long, bundle string, frame long, offset long, length long"
RECORD_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    uri = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")
    name = lambda i: f"<{_URN}{'null' if i is None else i}>"
    revisit = refers_to is not None
    block = _HTTP if revisit else _HTTP + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {name(page_id)}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest32(payload)}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head[3:3] = [f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple:
    """A row of RECORD_SCHEMA; responses are checked against their digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    number = lambda x: None if x is None or x.endswith("null>") else int(x[len(_URN) + 1:-1])
    block = rest[: int(fields["Content-Length"])]
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = None if kind == "revisit" else block.partition(b"\r\n\r\n")[2]
    if payload is not None and digest32(payload) != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} doesn't match its digest")
    return (number(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], int(fields["X-Payload-Length"]), digest, kind, number(fields.get("WARC-Refers-To")), payload)


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", c, d) for c, d in frames) + struct.pack("<IBI", len(frames), 0, _SEEKABLE)
    return struct.pack("<II", _SKIPPABLE, len(body)) + body


#: Hadoop's schemes that have another name here
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def read_seek_table(f) -> list[tuple[int, int, int]]:
    """(offset, compressed size, size) of each frame of an open bundle."""
    end = f.size()
    f.seek(end - 9)
    n, flags, magic = struct.unpack("<IBI", f.read(9))
    if magic != _SEEKABLE or flags & 0x80:
        raise ValueError("no seek table without checksums at the end of the bundle")
    f.seek(end - 9 - 8 * n)
    sizes = np.frombuffer(f.read(8 * n), "<u4").reshape(n, 2).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(sizes[:, 0])])
    return [(int(a), int(c), int(d)) for a, (c, d) in zip(at, sizes)]


def read_frame(f, table: list[tuple[int, int, int]], frame: int) -> bytes:
    at, packed, size = table[frame]
    f.seek(at)
    return zstandard.ZstdDecompressor().decompress(f.read(packed), max_output_size=size)


def revisits(spark: SparkSession, pages: DataFrame, ws: Workspace, min_bytes: int = 0) -> DataFrame:
    """(page_id, digest, refers_to) of the rows whose payload a smaller id has."""
    size = F.octet_length(F.coalesce(F.col("html"), F.lit("")))
    seen = ws.put(pages.filter(size >= min_bytes).select("page_id", _digest().alias("digest")), "digests")
    firsts = ws.put(seen.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null").select("digest", "first"), "firsts")
    later = seen.join(firsts, "digest").filter("page_id is null or page_id > first")
    return ws.put(later.select("page_id", "digest", F.col("first").alias("refers_to")).distinct(), "revisits")


def _digest():
    return F.unhex(F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary")))


def write_bundles(spark: SparkSession, pages: DataFrame, folder: str, ws: Workspace, min_bytes: int = 0, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write all pages as bundles in ``folder``; returns the written index."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    again = revisits(spark, pages, ws, min_bytes).withColumnsRenamed({"page_id": "again_id", "digest": "again_digest"})
    keyed = pages.withColumn("digest", _digest())
    typed = keyed.join(again, F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("digest") == F.col("again_digest")), "left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        pid, attempt = task.partitionId(), task.taskAttemptId()
        out = _Writer(folder, pid, attempt, frame_bytes, bundle_bytes)
        for b in batches:
            for page_id, url, html, refers in zip(*(c.to_pylist() if i != 2 else c for i, c in enumerate(b.columns))):
                payload = html.as_py()
                out.add(page_id, make_record(page_id, url, (payload or "").encode(), refers))
            if out.index:
                yield out.take()
        out.close()
        if out.index:
            yield out.take()

    # in a total order, so that a repeated task writes the same bundles again
    ordered = typed.sortWithinPartitions("page_id", "url", "digest")
    written = ordered.select("page_id", "url", "html", "refers_to").mapInArrow(write, INDEX_SCHEMA)
    return ws.put(written, "index")


def filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    """A folder's file system and the path in it; Hadoop's names of the same store are taken too."""
    scheme, colon, rest = folder.partition("://")
    return pafs.FileSystem.from_uri(SCHEMES.get(scheme, scheme) + colon + rest)


class _Writer:
    def __init__(self, folder: str, pid: int, attempt: int, frame_bytes: int, bundle_bytes: int):
        self.fs, self.root = filesystem(folder)
        self.fs.create_dir(self.root, recursive=True)
        self.pid, self.attempt, self.seq = pid, attempt, 0
        self.frame_bytes, self.bundle_bytes = frame_bytes, bundle_bytes
        self.file, self.frame, self.size, self.index = None, [], 0, []
        self.pack = zstandard.ZstdCompressor(level=3, write_content_size=True)

    def add(self, page_id: int | None, record: bytes) -> None:
        if self.file is None:
            self.name = f"bundle-{self.pid:06d}-{self.seq:04d}.warc.zst"
            self.temp = f"{self.root}/.{self.name}.{self.attempt}"
            self.file, self.frames, self.written = self.fs.open_output_stream(self.temp), [], 0
        self.index.append((page_id, self.name, len(self.frames), self.size, len(record)))
        self.frame.append(record)
        self.size += len(record)
        if self.size >= self.frame_bytes:
            self._flush()
            if self.written >= self.bundle_bytes:
                self.close()

    def _flush(self) -> None:
        raw = b"".join(self.frame)
        packed = self.pack.compress(raw)
        self.file.write(packed)
        self.frames.append((len(packed), len(raw)))
        self.written += len(packed)
        self.frame, self.size = [], 0

    def close(self) -> None:
        if self.file is None:
            return
        if self.frame:
            self._flush()
        self.file.write(seek_table(self.frames))
        self.file.close()
        self.fs.move(self.temp, f"{self.root}/{self.name}")
        self.file, self.seq = None, self.seq + 1

    def take(self) -> pa.RecordBatch:
        cols = list(zip(*self.index))
        self.index = []
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["page_id", "bundle", "frame", "offset", "length"])


def read_bundles(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records that the index names, read from their frames; a task reads a frame once."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        name, f, table, at, raw = None, None, None, None, b""
        for b in batches:
            rows = []
            for page_id, bundle, frame, offset, length in zip(*(c.to_pylist() for c in b.columns)):
                if bundle != name:
                    f = fs.open_input_file(f"{root}/{bundle}")
                    name, table, at = bundle, read_seek_table(f), None
                if frame != at:
                    at, raw = frame, read_frame(f, table, frame)
                row = parse_record(raw[offset:offset + length])
                if row[0] != page_id:
                    raise ValueError(f"the index names {page_id}, the archive has {row[0]}")
                rows.append(row if payloads else (*row[:-1], None))
                if sum(len(r[-1] or b"") for r in rows[-1:]) > FRAME_BYTES or len(rows) >= 256:
                    yield _records(rows)
                    rows = []
            if rows:
                yield _records(rows)

    ordered = index.select("page_id", "bundle", "frame", "offset", "length").repartition("bundle", F.floor(F.col("frame") / 16)).sortWithinPartitions("bundle", "frame", "offset")
    return ordered.mapInArrow(read, RECORD_SCHEMA)


def _records(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def lookup(index: DataFrame, folder: str, page_id: int) -> list[tuple]:
    """All records of one id, each from its own frame."""
    fs, root = filesystem(folder)
    out = []
    for r in index.filter(F.col("page_id") == page_id).collect():
        with fs.open_input_file(f"{root}/{r['bundle']}") as f:
            raw = read_frame(f, read_seek_table(f), r["frame"])
        out.append(parse_record(raw[r["offset"]:r["offset"] + r["length"]]))
    return out


def archive_pages(spark: SparkSession, pages: DataFrame, folder: str | None = None, **options) -> tuple[DataFrame, str]:
    """Write the pages as bundles; returns the index and the folder."""
    ws = Workspace(spark, "warc")
    folder = folder or f"{ws.path}/bundles"
    return write_bundles(spark, pages, folder, ws, **options), folder


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract rows over all pages, as read back from the archives."""
    index, folder = archive_pages(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return read_bundles(index, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = r"""
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hexed FROM pages),
digests AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(list_reduce(list_transform(range(5 * i, 5 * i + 5), lambda k:
        ((position(hexed[(k // 4 + 1)::BIGINT] IN '0123456789abcdef') - 1) >> (3 - k % 4)::INTEGER) & 1), lambda a, b: 2 * a + b) + 1)::BIGINT]), '') AS payload_digest
  FROM hashed),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM digests)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM firsts
"""
