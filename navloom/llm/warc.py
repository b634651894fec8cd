"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding a group of whole records, and a
footer: a skippable frame with every frame's compressed and plain size (the seek table of the
seekable format). The index maps each record to its bundle, frame and offset in the plain frame, so a
record is read by decompressing one frame. Of records with equal payloads one is a response, the
others are revisits without payload that refer to it.

Each task writes one bundle under a name of its attempt and moves it to its own when it is complete;
the bytes depend on the rows only, so a repeated attempt replaces a bundle by itself. Payloads are
never gathered by digest: the response of a digest is found by a partial aggregate on ids.

Defined results: a null html has the empty payload; a null url gives a record without target; of
equal payloads the largest id is the response, null ids are smaller than all others; of rows equal
in id and payload one counts as the largest; an empty table gives an empty index; other columns are
not read. The folder may be local or any that pyarrow.fs can open.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from navloom.llm.shared import keep, sliced

#: Plain bytes of records that fill a frame; a longer record is a frame of its own.
FRAME_BYTES = 1 << 20
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Fixed values of the seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEK_TABLE_MAGIC = 0x8F92EAB1
FOOTER_BYTES = 9

INDEX = "page_id long, bundle string, frame int, offset long, length long"
RECORDS = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(identifier: str) -> int | None:
    name = identifier.strip("<>").rpartition(":")[2]
    return None if name == "none" else int(name)


def encode_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~' + chr(39))}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest_of(payload)}")
    if revisit:
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def decode_record(plain: bytes, at: int) -> dict:
    """The record that begins at a place of a plain frame."""
    head_end = plain.index(b"\r\n\r\n", at)
    fields = _fields(plain[at:head_end])
    block = plain[head_end + 4 : head_end + 4 + int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and digest_of(payload) != digest:
        raise ValueError(f"payload of {fields['warc-record-id']} does not have its digest")
    return {
        "page_id": page_of(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "payload": payload if kind == "response" else None,
        "payload_bytes": len(payload) if kind == "response" else int(_fields(http)["content-length"]),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": page_of(fields["warc-refers-to"]) if kind == "revisit" else None,
    }


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


class BundleWriter:
    def __init__(self, out):
        self.out, self.frames, self.held = out, [], []
        self.held_bytes = 0
        self.compressor = zstandard.ZstdCompressor(level=3)

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame and offset that the record gets."""
        if self.held and self.held_bytes + len(record) > FRAME_BYTES:
            self._frame()
        place = len(self.frames), self.held_bytes
        self.held.append(record)
        self.held_bytes += len(record)
        return place

    def _frame(self) -> None:
        packed = self.compressor.compress(b"".join(self.held))
        self.out.write(packed)
        self.frames.append((len(packed), self.held_bytes))
        self.held, self.held_bytes = [], 0

    def close(self) -> None:
        if self.held:
            self._frame()
        table = b"".join(struct.pack("<II", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEK_TABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table) + FOOTER_BYTES) + table + footer)


class BundleReader:
    def __init__(self, source):
        self.source = source
        size = source.size()
        source.seek(size - FOOTER_BYTES)
        count, descriptor, magic = struct.unpack("<IBI", source.read(FOOTER_BYTES))
        if magic != SEEK_TABLE_MAGIC or descriptor:
            raise ValueError("not a seekable bundle")
        source.seek(size - FOOTER_BYTES - 8 * count)
        sizes = list(struct.iter_unpack("<II", source.read(8 * count)))
        self.frames, at = [], 0
        for packed, plain in sizes:
            self.frames.append((at, packed, plain))
            at += packed

    def frame(self, number: int) -> bytes:
        at, packed, plain = self.frames[number]
        self.source.seek(at)
        return zstandard.ZstdDecompressor().decompress(self.source.read(packed), max_output_size=plain)


def _folder(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if re.match(r"[a-z][a-z0-9+.-]*:", path) else (fs.LocalFileSystem(), path)


def _written(path: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _folder(path)
        task = TaskContext.get()
        name = f"bundle-{task.partitionId():06d}.warc.zst"
        attempt = f"{folder}/_attempts/{name}-{task.taskAttemptId()}"
        index: dict[str, list] = {c: [] for c in ("page_id", "frame", "offset", "length")}
        store.create_dir(f"{folder}/_attempts", recursive=True)
        with store.open_output_stream(attempt) as out:
            bundle = BundleWriter(out)
            for batch in sliced(batches, "html"):
                for row in batch.to_pylist():
                    payload = (row["html"] or "").encode()
                    record = encode_record(row["page_id"], row["url"], payload, row["response_id"], row["revisit"])
                    frame, offset = bundle.add(record)
                    for c, value in zip(index.values(), (row["page_id"], frame, offset, len(record)), strict=True):
                        c.append(value)
            bundle.close()
        store.move(attempt, f"{folder}/{name}")
        n = len(index["page_id"])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(index["page_id"], pa.int64()),
                pa.array([name] * n, pa.string()),
                pa.array(index["frame"], pa.int32()),
                pa.array(index["offset"], pa.int64()),
                pa.array(index["length"], pa.int64()),
            ],
            names=["page_id", "bundle", "frame", "offset", "length"],
        )

    return write


def marked(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages with response_id and revisit; payloads under `least_bytes` are all responses."""
    rows = pages.select("page_id", "url", "html", F.sha1(F.encode(F.coalesce("html", F.lit("")), "UTF-8")).alias("digest"))
    long_enough = F.octet_length(F.coalesce("html", F.lit(""))) >= least_bytes
    ids = rows.where(long_enough).groupBy("page_id", "digest").agg(F.count(F.lit(1)).alias("copies"))
    ids = keep(ids, "ids")
    responses = ids.groupBy("digest").agg(F.max("page_id").alias("response_id"), F.sum("copies").alias("rows"))
    others = keep(
        ids.join(responses.where("rows > 1"), "digest").select(F.col("page_id").alias("id"), F.col("digest").alias("of"), "response_id", "copies"),
        "revisits",
    )
    same = F.col("page_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("of"))
    joined = rows.join(others, same, "left")
    first = F.lit(1)
    if not others.where("copies > 1").isEmpty():
        first = F.row_number().over(Window.partitionBy("page_id", "digest").orderBy("url"))
    joined = joined.withColumn("number", first)
    largest = F.col("page_id").eqNullSafe(F.col("response_id")) & (F.col("number") == 1)
    revisit = F.col("of").isNotNull() & ~largest
    return joined.select("page_id", "url", "html", "response_id", revisit.alias("revisit"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> DataFrame:
    """Write one bundle per task under `path`; the stored index: page_id, bundle, frame, offset, length."""
    return keep(marked(pages, least_bytes).mapInArrow(_written(path), INDEX), "index")


def _read(path: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _folder(path)
        opened, bundle, number, plain = "", None, -1, b""
        schema = pa.schema(
            [("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
             ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
        )
        for batch in batches:
            held, size = [], 0
            for row in batch.to_pylist():
                if row["bundle"] != opened:
                    opened, number = row["bundle"], -1
                    bundle = BundleReader(store.open_input_file(f"{folder}/{opened}"))
                if row["frame"] != number:
                    number = row["frame"]
                    plain = bundle.frame(number)
                record = decode_record(plain, row["offset"])
                if record["page_id"] != row["page_id"]:
                    raise ValueError(f"{opened}: the record at {number}, {row['offset']} is not of page {row['page_id']}")
                held.append(record)
                size += row["length"]
                if size > FRAME_BYTES:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_pylist(held, schema)

    return read


def read_archives(index: DataFrame, path: str) -> DataFrame:
    """The records that the index names, read from their frames; payload is null for revisits."""
    return index.mapInArrow(_read(path), RECORDS)
