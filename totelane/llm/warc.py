"""Operator 13: web archives of independent Zstandard frames with a footer that finds them.

A page is a WARC 1.1 record. Of pages with the same payload the one with the smallest id is
stored, as a response; the others are revisits, which name its record and hold none. Records
side by side are grouped into frames of about ``FRAME_BYTES``, each compressed by itself; a
bundle ends with the seek table of the seekable Zstandard format, a frame that other readers
skip, with the sizes and a checksum of every frame. The index, a Parquet table, has the frame
and the place in it of each record, so one record costs the footer and one frame.

A null payload counts as empty. Of repeated ids with the same payload the first in the scan
is the response. A page without an id is stored only where no page with the same payload has
one, and is referred to as null. A page without an address has the address ``about:blank``.
Payloads are the same if their SHA-256 and length are; those below ``least`` bytes are all
stored. An empty table gives no bundles. Each attempt of a task writes a bundle of its own
name, and only those in the index count, so lost or repeated tasks leave no wrong records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from totelane.llm.common import as_bytes, hot_groups, meet, prepare, record_batch, slices
from totelane.session import durable, shared_folder

#: Bytes of records in a frame, unless a single record has more.
FRAME_BYTES = 1 << 20
LEVEL = 3
_AT_ONCE = 4 << 20
# Fixed values of the seekable format and of the archive format.
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_CHECKSUMS = 0x80
_ENTRY, _FOOTER = struct.Struct("<III"), struct.Struct("<IBI")
_VERSION = "WARC/1.1"
_SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"

_INDEX = (
    "record_id string, page_id bigint, record_type string, source_id string, file string, "
    "frame int, offset bigint, length bigint"
)
_READ = (
    "record_id string, page_id bigint, url string, record_type string, refers_to bigint, "
    "payload_bytes bigint, payload_digest string, payload binary"
)
_KINDS = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


@dataclass(frozen=True)
class Archives:
    """``folder`` holds the bundles, ``index`` says where each record is."""

    folder: str
    index: DataFrame


class FrameWriter:
    """Writes records to a bundle, frame by frame."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES):
        self._out, self._most = out, frame_bytes
        self._packer = zstandard.ZstdCompressor(level=LEVEL)
        self._waiting: list[bytes] = []
        self._size, self._entries = 0, []

    def add(self, record: bytes) -> tuple[int, int]:
        """The frame of the record and its offset there."""
        if self._size and self._size + len(record) > self._most:
            self._flush()
        place = (len(self._entries), self._size)
        self._waiting.append(record)
        self._size += len(record)
        return place

    def _flush(self) -> None:
        content = b"".join(self._waiting)
        packed = self._packer.compress(content)
        self._out.write(packed)
        check = xxhash.xxh64_intdigest(content) & 0xFFFFFFFF
        self._entries.append(_ENTRY.pack(len(packed), len(content), check))
        self._waiting, self._size = [], 0

    def close(self) -> None:
        if self._waiting:
            self._flush()
        table = b"".join(self._entries) + _FOOTER.pack(len(self._entries), _CHECKSUMS, _SEEKABLE)
        self._out.write(struct.pack("<II", _SKIPPABLE, len(table)) + table)
        self._out.close()


class FrameReader:
    """Reads frames of a bundle by their number; the last one is remembered."""

    def __init__(self, source):
        self._source, size = source, source.size()
        n, flags, magic = _FOOTER.unpack(source.read_at(_FOOTER.size, size - _FOOTER.size))
        if magic != _SEEKABLE or flags != _CHECKSUMS:
            raise ValueError("the bundle has no seek table with checksums at its end")
        table = n * _ENTRY.size
        raw = source.read_at(table + 8, size - _FOOTER.size - table - 8)
        if struct.unpack("<II", raw[:8]) != (_SKIPPABLE, table + _FOOTER.size):
            raise ValueError("the seek table does not match its length")
        self._entries, start = [], 0
        for packed, plain, check in _ENTRY.iter_unpack(raw[8:]):
            self._entries.append((start, packed, plain, check))
            start += packed
        self._last: tuple[int, bytes] = (-1, b"")

    def __len__(self) -> int:
        return len(self._entries)

    def frame(self, number: int) -> bytes:
        if self._last[0] != number:
            start, packed, plain, check = self._entries[number]
            raw = self._source.read_at(packed, start)
            content = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
            if len(content) != plain or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != check:
                raise ValueError(f"frame {number} does not match its length or checksum")
            self._last = (number, content)
        return self._last[1]


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, place: int) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{place}')}"


def _address(url: str | None) -> str:
    """Header lines hold no blanks or control characters."""
    return re.sub(r"[\x00-\x20\x7f]", lambda x: quote(x.group()), url or "") or "about:blank"


def _head(lines: list[tuple[str, object]], first: str) -> bytes:
    return "\r\n".join([first, *(f"{name}: {value}" for name, value in lines)]).encode() + _END


def _record(row: dict, payload: bytes, date: str) -> bytes:
    """The record of a page; a revisit holds the answer's head without the payload."""
    revisit = row["refers_at"] is not None
    answer = _head(
        [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))],
        "HTTP/1.1 200 OK",
    )
    block = answer if revisit else answer + payload
    lines = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{record_id(row['page_id'], row['at'])}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", _address(row["url"])),
        ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"),
    ]
    if row["page_id"] is not None:
        lines.append(("Page-Id", row["page_id"]))
    if revisit:
        lines += [
            ("WARC-Profile", _SAME_PAYLOAD),
            ("WARC-Refers-To", f"<{record_id(row['refers_to'], row['refers_at'])}>"),
            ("WARC-Refers-To-Target-URI", _address(row["refers_url"])),
            ("WARC-Refers-To-Date", date),
        ]
        if row["refers_to"] is not None:
            lines.append(("Refers-To-Page-Id", row["refers_to"]))
    lines += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block))]
    return _head(lines, _VERSION) + block + _END


def _fields(head: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = head.decode().split("\r\n")
    return first, dict(line.split(": ", 1) for line in lines)


def parsed(record: bytes) -> dict:
    """What a record says. A response must match its lengths and digest, a revisit its length."""
    head, rest = record.split(_END, 1)
    version, fields = _fields(head)
    size = int(fields["Content-Length"])
    block, end = rest[:size], rest[size:]
    if version != _VERSION or end != _END:
        raise ValueError("a record does not match its version or length")
    answer, payload = block.split(_END, 1)
    payload_bytes = int(_fields(answer)[1]["Content-Length"])
    response = fields["WARC-Type"] == "response"
    kind, said = fields["WARC-Payload-Digest"].split(":")
    if response and (len(payload) != payload_bytes or sha1_base32(payload) != said) or kind != "sha1":
        raise ValueError("a payload does not match its length or digest")
    ids = [fields.get(name) for name in ("Page-Id", "Refers-To-Page-Id")]
    page_id, refers_to = (None if x is None else int(x) for x in ids)
    return {
        "record_id": fields["WARC-Record-ID"][1:-1],
        "page_id": page_id,
        "url": fields["WARC-Target-URI"],
        "record_type": fields["WARC-Type"],
        "refers_to": refers_to,
        "payload_bytes": payload_bytes,
        "payload_digest": said,
        "payload": payload if response else None,
    }


def _writer(folder: str, date: str, frame_bytes: int):
    names = ("at", "page_id", "url", "refers_to", "refers_at", "refers_url")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pa.fs.FileSystem.from_uri(folder)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.zst"
        schema, bundle = _schema(_INDEX), None
        for batch in slices(batches, "html", _AT_ONCE):
            # Left alone, the stream would compress what goes to a file of this name.
            bundle = bundle or FrameWriter(
                files.open_output_stream(f"{root}/{name}", compression=None), frame_bytes
            )
            out: dict[str, list] = {field.name: [] for field in schema}
            rows = batch.select(names).to_pylist()
            for row, payload in zip(rows, as_bytes(batch.column("html")), strict=True):
                record = _record(row, payload, date)
                frame, offset = bundle.add(record)
                own, revisit = record_id(row["page_id"], row["at"]), row["refers_at"] is not None
                source = record_id(row["refers_to"], row["refers_at"]) if revisit else own
                kind = "revisit" if revisit else "response"
                values = (own, row["page_id"], kind, source, name, frame, offset, len(record))
                for column, value in zip(out, values, strict=True):
                    out[column].append(value)
            yield record_batch(out, schema)
        if bundle:
            bundle.close()

    return write


def _revisits(stored: DataFrame, least: int) -> DataFrame:
    """``at`` of each page that repeats a payload, and ``refers_to``, ``refers_at``,
    ``refers_url`` of the page that is stored."""
    hashed = durable(
        stored.filter(F.octet_length("html") >= least).select(
            "at", "page_id", "url", F.concat_ws(":", F.octet_length("html"), F.sha2("html", 256)).alias("key")
        )
    )
    first = F.struct(F.col("page_id").isNull().alias("nameless"), "page_id", "at", "url")
    groups = hashed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("first"))
    groups = durable(groups.filter("n > 1"))
    found = meet(
        hashed.select("at", "key"), groups.select("key", "first"), "key", "inner", hot_groups(groups, "key")
    )
    return found.filter(F.col("at") != F.col("first.at")).select(
        "at",
        F.col("first.page_id").alias("refers_to"),
        F.col("first.at").alias("refers_at"),
        F.col("first.url").alias("refers_url"),
    )


def write_archives(
    pages: DataFrame,
    date: str,
    folder: str | None = None,
    least: int = 0,
    frame_bytes: int = FRAME_BYTES,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> Archives:
    """Store all pages, as read at ``date`` (such as 2024-01-01T00:00:00Z); ``folder`` must be
    one that all executors reach. Payloads are written once more beside the bundles, with the
    place of their row, and move only if the revisits are too many to be sent to them."""
    spark = pages.sparkSession
    prepare(spark)
    folder = folder or f"{shared_folder(spark)}/totelane/archives-{uuid.uuid4().hex}"
    folder = folder if ":/" in folder else f"file://{folder}"
    files, root = pa.fs.FileSystem.from_uri(f"{folder}/data")
    files.create_dir(root)
    stored = durable(
        pages.select(
            F.monotonically_increasing_id().alias("at"),
            F.col(id_col).cast("long").alias("page_id"),
            F.col(url_col).alias("url"),
            F.coalesce(F.col(html_col), F.lit("")).alias("html"),
        )
    )
    rows = meet(stored, durable(_revisits(stored, least)), "at", "left")
    index = rows.mapInArrow(_writer(f"{folder}/data", date, frame_bytes), _INDEX)
    index.write.mode("error").parquet(f"{folder}/index")
    return open_archives(spark, folder)


def open_archives(spark: SparkSession, folder: str) -> Archives:
    return Archives(folder, spark.read.schema(_INDEX).parquet(f"{folder}/index"))


def _reader(folder: str, with_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pa.fs.FileSystem.from_uri(folder)
        schema, opened, bundle = _schema(_READ), None, None
        for batch in batches:
            out: list[dict] = []
            size = 0
            for row in batch.select(["file", "frame", "offset", "length"]).to_pylist():
                if row["file"] != opened:
                    opened = row["file"]
                    bundle = FrameReader(files.open_input_file(f"{root}/{opened}"))
                start = row["offset"]
                found = parsed(bundle.frame(row["frame"])[start : start + row["length"]])
                if not with_payload:
                    found["payload"] = None
                out.append(found)
                size += len(found["payload"] or b"")
                if size > _AT_ONCE:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out, size = [], 0
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return read


def read_archives(archives: Archives, with_payload: bool = True) -> DataFrame:
    """Each record read back through the index and the seek tables; a revisit has no payload
    of its own."""
    return archives.index.mapInArrow(_reader(f"{archives.folder}/data", with_payload), _READ)


def payloads(archives: Archives, page_ids: DataFrame) -> DataFrame:
    """``page_id`` and ``payload`` of the pages in ``page_ids.page_id``, those of revisits from
    the records they refer to; each record is read once, however many refer to it."""
    index = archives.index
    wanted = index.join(page_ids.select("page_id").distinct(), "page_id", "left_semi")
    wanted = durable(wanted.select("page_id", "source_id"))
    sources = index.join(
        wanted.select(F.col("source_id").alias("record_id")).distinct(), "record_id", "left_semi"
    )
    found = read_archives(Archives(archives.folder, sources.sortWithinPartitions("file", "frame", "offset")))
    found = found.select(F.col("record_id").alias("source_id"), "payload")
    return wanted.join(found, "source_id").select("page_id", "payload")
