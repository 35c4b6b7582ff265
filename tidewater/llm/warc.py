"""WARC archives as seekable Zstandard bundles.

A bundle is one file: groups of records in independent Zstandard frames, a
skippable frame with the record index (record id, frame, offset and length
inside the decompressed frame), and the footer seek table of the seekable
format, a skippable frame with the compressed and decompressed size of every
frame before it. Any Zstandard tool reads a bundle from start to end; a reader
that wants one record opens the seek table, the index and one frame.

Records are dealt to bundles by a hash of their id; a bundle holds about
``BUNDLE_BYTES`` of payload and is what one task holds at a time. Files are
written through Spark's text sink, which copies the bytes of a row as they are
to any file system Spark can reach: a row is a bundle without its last four
bytes, and the line separator is those four, the seek table's magic number.
Spark's commit makes retried tasks harmless.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes the one with
the smallest id is a response and the others are revisits without a payload.

Defined results: null payload: empty; null urls: empty; null ids are written
as ``null`` and read back as null; smaller payloads are always responses; rows
that repeat the smallest id are all responses; an empty table writes and reads
no records. Extra columns are not archived.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the formats: skippable frame magic numbers, seek table magic number.
INDEX_MAGIC, SEEK_MAGIC, FOOTER_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MIN_REVISIT = 100
BUNDLE_BYTES = 16 << 20
FRAME_BYTES = 256 << 10
DATE = "2024-01-01T00:00:00Z"     # capture date where the caller has none
ID = "urn:page:"


def _described(records: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    data = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    return records.select(F.col(key).alias("key"), F.coalesce(F.col(url), F.lit("")).alias("url"), data.alias("payload")).withColumns(
        {"digest": F.sha2("payload", 256), "bytes": F.octet_length("payload").cast("long")})


def revisits(records: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """key, url, digest and refers_to of the records that repeat the payload
    of a smaller id. No payload is moved for it."""
    p = _described(records, key, url, payload).where(F.col("bytes") >= MIN_REVISIT).select("key", "url", "digest")
    first = (p.groupBy("digest").agg(F.min("key").alias("refers_to"), F.count(F.lit(1)).alias("n"))
             .where("n > 1 AND refers_to IS NOT NULL").select("digest", "refers_to"))
    return p.join(first, "digest").where(~F.col("key").eqNullSafe(F.col("refers_to"))).select("key", "url", "digest", "refers_to")


def record_bytes(key, url: str, payload: bytes, digest: str, size: int, kind: str, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP head of what it repeats."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{ID}{'null' if key is None else key}>",
             f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~-._' + chr(39))}", f"WARC-Date: {DATE}",
             f"WARC-Payload-Digest: sha256:{digest}"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{ID}{refers_to}>"]
    block = head + payload
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Named fields (lower-case) and the payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    fields = {k.lower(): v for k, v in fields.items()}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    for line in http.decode().split("\r\n")[1:]:
        name, _, value = line.partition(": ")
        fields["http-" + name.lower()] = value
    return fields, payload


def bundle_bytes(records: list[tuple[str, bytes]], frame_bytes: int = FRAME_BYTES) -> bytes:
    """A whole bundle of (record id, record)."""
    press = zstandard.ZstdCompressor(level=3, write_content_size=True)
    frames, sizes, index, now, at = [], [], [], [], 0

    def close() -> None:
        nonlocal now, at
        if now:
            raw = b"".join(now)
            frames.append(press.compress(raw))
            sizes.append((len(frames[-1]), len(raw)))
            now, at = [], 0

    for name, data in records:
        if at and at + len(data) > frame_bytes:
            close()
        index.append(f"{name}\t{len(sizes)}\t{at}\t{len(data)}\n")
        now.append(data)
        at += len(data)
    close()
    listed = press.compress("".join(index).encode())
    frames.append(struct.pack("<II", INDEX_MAGIC, len(listed)) + listed)
    sizes.append((len(frames[-1]), 0))
    table = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IBI", len(sizes), 0, FOOTER_MAGIC)
    return b"".join(frames) + struct.pack("<II", SEEK_MAGIC, len(table)) + table


class Bundle:
    """Random access to a bundle's records."""

    def __init__(self, content: bytes):
        count, flags, magic = struct.unpack("<IBI", content[-9:])
        if magic != FOOTER_MAGIC or flags:
            raise ValueError("no seek table at the end of the bundle")
        table = content[-9 - 8 * count:-9]
        if struct.unpack("<II", content[-17 - 8 * count:-9 - 8 * count]) != (SEEK_MAGIC, len(table) + 9):
            raise ValueError("the seek table is damaged")
        self.content, self.frames, at = content, [], 0
        for packed, size in struct.iter_unpack("<II", table):
            self.frames.append((at, packed, size))
            at += packed
        at, packed, _ = self.frames.pop()
        listed = zstandard.ZstdDecompressor().decompress(content[at + 8:at + packed])
        self.index = [(name, int(f), int(o), int(n)) for name, f, o, n in (x.split("\t") for x in listed.decode().splitlines())]
        self._open: tuple[int, bytes] = (-1, b"")

    def frame(self, k: int) -> bytes:
        if self._open[0] != k:
            at, packed, size = self.frames[k]
            self._open = (k, zstandard.ZstdDecompressor().decompress(self.content[at:at + packed], max_output_size=size))
        return self._open[1]

    def record(self, entry: tuple[str, int, int, int]) -> bytes:
        _, frame, offset, length = entry
        return self.frame(frame)[offset:offset + length]


def _bundle_group(group: pa.Table, again: pa.Table) -> pa.Table:
    """The bundle of a group of records, of which ``again`` lists the revisits."""
    found = pa.schema([("bundle", pa.int64()), ("content", pa.binary())])
    if not group.num_rows:
        return found.empty_table()
    order = [("key", "ascending"), ("url", "ascending"), ("digest", "ascending")]
    group = group.sort_by(order)
    refers = dict(zip(zip(*(again.column(c).to_pylist() for c in ("key", "url", "digest"))), again.column("refers_to").to_pylist()))
    records = []
    for key, url, payload, digest in zip(*(group.column(c).to_pylist() for c in ("key", "url", "payload", "digest"))):
        size, kind, to = len(payload), "response", refers.get((key, url, digest))
        if to is not None:
            kind, payload = "revisit", b""
        records.append((f"{ID}{'null' if key is None else key}", record_bytes(key, url, payload, digest, size, kind, to)))
    return pa.Table.from_arrays([pa.array([group.column("bundle")[0].as_py()], pa.int64()), pa.array([bundle_bytes(records)], pa.binary())], schema=found)


def write_archive(records: DataFrame, path: str, bundle_bytes_: int = BUNDLE_BYTES, key: str = "page_id", url: str = "url",
                  payload: str = "html") -> None:
    """Write ``records`` as bundles under ``path``, one file a bundle in a
    folder ``bundle=N``. Payloads are shuffled once, to their bundles."""
    total = records.agg(F.sum(F.octet_length(F.col(payload).cast("binary")))).first()[0] or 0
    bundle = F.pmod(F.xxhash64("key", "url", "digest"), F.lit(max(1, -(-total // bundle_bytes_)))).alias("bundle")
    dealt = _described(records, key, url, payload).select(bundle, "key", "url", "payload", "digest")
    again = revisits(records, key, url, payload).select(bundle, "key", "url", "digest", "refers_to")
    made = dealt.groupBy("bundle").cogroup(again.groupBy("bundle")).applyInArrow(_bundle_group, "bundle long, content binary")
    body = F.expr("substring(content, 1, octet_length(content) - 4)").cast("string")
    (made.select("bundle", body.alias("value")).write.partitionBy("bundle")
     .option("encoding", "ISO-8859-1").option("lineSep", struct.pack("<I", FOOTER_MAGIC).decode("latin-1")).text(path))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            entries = Bundle(content.as_buffer().to_pybytes()).index
            cols = list(zip(*entries)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array([path] * len(entries), pa.string()), pa.array(cols[0], pa.string()),
                                              *[pa.array(c, pa.int64()) for c in cols[1:]]], names=["path", "record_id", "frame", "offset", "length"])


def record_index(spark: SparkSession, path: str) -> DataFrame:
    """path, record_id, frame, offset, length of every archived record."""
    return _files(spark, path).mapInArrow(_index, "path string, record_id string, frame long, offset long, length long")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["record_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    for batch in batches:
        for content in batch.column("content"):
            bundle, rows, held = Bundle(content.as_buffer().to_pybytes()), [], 0
            for entry in bundle.index:
                fields, payload = parse_record(bundle.record(entry))
                kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
                size = int(fields["http-content-length"])
                if fields["warc-record-id"].strip("<>") != entry[0]:
                    raise ValueError(f"the index is wrong for {entry[0]}")
                if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                    raise ValueError(f"the payload of {entry[0]} is damaged")
                rows.append((entry[0], fields["warc-target-uri"], kind, fields.get("warc-refers-to", "").strip("<>") or None, size, digest,
                             payload if kind == "response" else None))
                held += len(payload)
                if held > FRAME_BYTES * 8:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """All records under ``path``; payloads of responses are checked against
    their digests; a revisit's payload is null, its size and digest are those of
    the payload it repeats."""
    return _files(spark, path).mapInArrow(
        _records, "record_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary")
