"""WARC archives as seekable Zstandard bundles, with an index of records.

A bundle is a file of independent Zstandard frames. Each frame holds whole records; a skippable frame
at the end lists the sizes of all frames (the public seekable format), so that one record costs
one ranged read. The index maps a record to bundle, frame and place within the decompressed frame.
Payloads that occur more than once are written once, as the response of the largest id; the other
records are revisits that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.plans import stage

FRAME_BYTES = 1 << 20  # of records, before compression
BUNDLE_BYTES = 256 << 20
FRAMES_PER_TASK = 32

# Seekable format. Fixed values.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

ID_PREFIX = "urn:edgeloom:page:"
DATE = "1970-01-01T00:00:00Z"  # pages have no date
INDEX = ("page_id bigint, bundle string, frame bigint, frame_start bigint, frame_size bigint, "
         "record_start bigint, record_size bigint")


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The footer for ``(compressed, decompressed)`` sizes of the frames."""
    body = b"".join(struct.pack("<II", *sizes) for sizes in frames)
    body += struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(file) -> list[tuple[int, int, int]]:
    """``(start, compressed, decompressed)`` of each frame of an open bundle."""
    size = file.size()
    file.seek(size - 9)
    count, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    entry = 12 if flags & 0x80 else 8
    file.seek(size - 9 - count * entry)
    body, start, frames = file.read(count * entry), 0, []
    for i in range(count):
        packed, plain = struct.unpack_from("<II", body, i * entry)
        frames.append((start, packed, plain))
        start += packed
    return frames


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id, url: str | None, payload_size: int, digest: str, payload: bytes | None, refers_to) -> bytes:
    """One WARC/1.1 record. A revisit (``payload`` None) keeps the HTTP header of the full payload only."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_size}\r\n\r\n".encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if payload is not None else 'revisit'}",
        f"WARC-Record-ID: <{ID_PREFIX}{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if payload is None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <{ID_PREFIX}{refers_to}>"]
    else:
        block += payload
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_ID = re.compile(rf"<{ID_PREFIX}(-?\d*)>")


def _id(value: str | None) -> int | None:
    found = _ID.fullmatch(value or "")
    return int(found[1]) if found and found[1] else None


def parse_record(data: bytes, start: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Header, block and end of the record at ``start``."""
    head_end = data.index(b"\r\n\r\n", start)
    lines = data[start:head_end].decode().split("\r\n")
    header = dict(line.split(": ", 1) for line in lines[1:])
    block_start = head_end + 4
    block_end = block_start + int(header["Content-Length"])
    return header, data[block_start:block_end], block_end + 4


def page_of(header: dict[str, str], block: bytes) -> tuple:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to, html)`` of a parsed record."""
    http, payload = block.split(b"\r\n\r\n", 1)
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = header["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = header["WARC-Type"]
    if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"{header['WARC-Record-ID']} is damaged")
    return (_id(header["WARC-Record-ID"]), size, digest, kind, _id(header.get("WARC-Refers-To")),
            payload if kind == "response" else None)


def _open_folder(folder: str):
    """File system and path of a folder that executors share (file, HDFS, or an object store)."""
    return fs.FileSystem.from_uri(folder)


class _Bundles:
    """Writes the records of one task, closing a bundle when it is full.

    A file has a name of its own per attempt, and only files that the index names are ever read, so a
    task that is run again leaves a stray file and no wrong record.
    """

    def __init__(self, folder: str, frame_bytes: int, bundle_bytes: int):
        self.files, self.folder = _open_folder(folder)
        self.frame_bytes, self.bundle_bytes = frame_bytes, bundle_bytes
        self.packer = zstandard.ZstdCompressor(level=3)
        self.out, self.buffer, self.waiting, self.done = None, bytearray(), [], []

    def add(self, page_id, record: bytes) -> None:
        self.waiting.append((page_id, len(self.buffer), len(record)))
        self.buffer += record
        if len(self.buffer) >= self.frame_bytes:
            self.flush()
            if self.start >= self.bundle_bytes:
                self.close()

    def flush(self) -> None:
        if not self.waiting:
            return
        if self.out is None:
            self.name = f"bundle-{uuid.uuid4().hex}.warc.zst"
            self.out, self.frames, self.start = self.files.open_output_stream(
                f"{self.folder}/{self.name}", compression=None), [], 0
        packed = self.packer.compress(bytes(self.buffer))
        self.out.write(packed)
        self.done += [(page_id, self.name, len(self.frames), self.start, len(packed), at, size)
                      for page_id, at, size in self.waiting]
        self.frames.append((len(packed), len(self.buffer)))
        self.start += len(packed)
        self.buffer, self.waiting = bytearray(), []

    def close(self) -> None:
        self.flush()
        if self.out is not None:
            self.out.write(seek_table(self.frames))
            self.out.close()
            self.out = None

    def index(self) -> pa.RecordBatch:
        rows, self.done = self.done, []
        columns = zip(*rows) if rows else [[]] * 7
        kinds = [pa.int64(), pa.string(), *[pa.int64()] * 5]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                          [field.split()[0] for field in INDEX.split(", ")])


def deduplicated(pages: DataFrame) -> DataFrame:
    """``(page_id, url, html, digest, refers_to)``: which page's payload stands for each.

    Payloads are compared by SHA-1 and length. Only narrow rows meet on the digest, where one may have a
    third of all pages: ids are folded before that shuffle, and pages with a payload of their own never come back
    from it. The pages are shuffled once, by their ids.
    """
    # a null html is an empty payload
    pages = pages.selectExpr("CAST(page_id AS bigint) AS page_id", "CAST(url AS string) AS url",
                             "coalesce(CAST(html AS binary), X'') AS html").withColumn("digest", F.unhex(F.sha1("html")))
    kept = pages.groupBy("digest", F.length("html").alias("size")).agg(
        F.max("page_id").alias("kept_id"), F.count("*").alias("n")).where("n > 1 AND kept_id IS NOT NULL")
    moved = pages.select("page_id", "digest", F.length("html").alias("size")).join(
        kept.drop("n").hint("merge"), ["digest", "size"]).where("NOT page_id <=> kept_id").groupBy(
        "page_id", "digest", "size").agg(F.max("kept_id").alias("refers_to"))
    return pages.sparkSession.sql("""
        SELECT /*+ MERGE(m) */ p.page_id, url, html, p.digest, refers_to FROM {pages} p LEFT JOIN {moved} m
        ON p.page_id <=> m.page_id AND p.digest = m.digest AND length(html) = m.size""", pages=pages, moved=moved)


def write_bundles(pages: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES,
                  bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write a record per row of ``pages(page_id, url, html)`` below ``folder``; returns the index (see ``INDEX``).

    A null html is an empty payload, a null url an empty one. Of records with equal payloads those with the
    largest id are responses, the others revisits; a null id is a revisit where any other has the payload.
    Rows repeated with their id are each written. An empty table writes no bundle.
    """
    _open_folder(folder)[0].create_dir(_open_folder(folder)[1], recursive=True)

    def write(batches):
        bundles = _Bundles(folder, frame_bytes, bundle_bytes)
        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            for i in range(batch.num_rows):
                page_id, url, html, digest, refers_to = (c[i].as_py() for c in columns)
                name = base64.b32encode(digest).decode()
                bundles.add(page_id, record_bytes(
                    page_id, url, len(html), name, html if refers_to is None else None, refers_to))
            if bundles.done:
                yield bundles.index()
        bundles.close()
        yield bundles.index()

    return stage(deduplicated(pages).mapInArrow(write, INDEX), "warc-index")


READ = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
        "html binary")


def _page_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    columns = zip(*rows) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                      [field.split()[0] for field in READ.split(", ")])


def read_bundles(index: DataFrame, folder: str) -> DataFrame:
    """Every record of the bundles that ``index`` names (see ``READ``), a frame at a time.

    ``html`` is null for revisits. A response whose payload is not that of its digest is an error.
    """
    def read(batches):
        files, root = _open_folder(folder)
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            for name, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with files.open_input_file(f"{root}/{name}") as file:
                    start, packed, plain = read_seek_table(file)[at]
                    file.seek(start)
                    data = unpacker.decompress(file.read(packed), max_output_size=plain)
                rows, end = [], 0
                while end < len(data):
                    header, block, end = parse_record(data, end)
                    rows.append(page_of(header, block))
                yield _page_batch(rows)

    # frames, not bundles, are dealt out: they are of one size
    frames = index.select("bundle", "frame").distinct()
    return frames.repartition(max(1, frames.count() // FRAMES_PER_TASK)).mapInArrow(read, READ)


def lookup(index: DataFrame, folder: str, wanted: DataFrame) -> DataFrame:
    """The records of ``wanted(page_id)``, each by one ranged read of the frame that holds it."""
    def read(batches):
        files, root = _open_folder(folder)
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for entry in batch.to_pylist():
                with files.open_input_file(f"{root}/{entry['bundle']}") as file:
                    file.seek(entry["frame_start"])
                    data = unpacker.decompressobj().decompress(file.read(entry["frame_size"]))
                header, block, _ = parse_record(data, entry["record_start"])
                rows.append(page_of(header, block))
            yield _page_batch(rows)

    return index.join(wanted.select("page_id").distinct(), "page_id").mapInArrow(read, READ)
