"""Operator 1: token ids as length-delimited binary records with an offset index.

A file is a run of records: length (8 bytes), masked CRC-32C of the length (4), payload,
masked CRC-32C of the payload (4), all little-endian. The payload is one byte for the width
of an id, one for whether the document has an id, 8 bytes of document id, then the token
ids. The index is a separate Parquet table with the file, offset and length of each record,
so that single records can be read in any order.

Null texts count as empty, so every row gives a record, of the end id at least. Rows are in
ascending order of doc_id, null ids first; repeated ids stand side by side in order of their
text. An empty table gives no files. Each attempt of a task writes a file of its own name,
and only files named in the index count, so lost or repeated tasks leave no wrong rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from totelane.llm import tokens
from totelane.llm.common import as_bytes, entries, record_batch, shuffle_partitions, slices
from totelane.llm.crc32c import crc32c, masked
from totelane.session import shared_folder

_AT_ONCE = 1 << 22
#: Encoded chunks to remember: sorted by id, texts of a task have little in common.
_REMEMBERED = 1_200_000
_HEAD, _FOOT, _PREFIX = 12, 4, 10
_INDEX = "file string, part int, place long, doc_id long, offset long, length long, before long, n_tokens long"
_READ = "part int, doc_id long, before long, n_tokens long, ids_crc32 long, ids binary"


@dataclass(frozen=True)
class Records:
    """``folder`` holds the files, ``index`` the offsets; ``end_id`` closes each record."""

    folder: str
    index: DataFrame


def _schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def payloads(ids: list[np.ndarray], doc_ids: list[int | None]) -> list[bytes]:
    return [
        bytes([own.dtype.itemsize, doc_id is not None])
        + (doc_id or 0).to_bytes(8, "little", signed=True)
        + own.tobytes()
        for own, doc_id in zip(ids, doc_ids, strict=True)
    ]


def framed(contents: list[bytes]) -> list[bytes]:
    """The records around the payloads."""
    heads = [len(x).to_bytes(8, "little") for x in contents]
    head_sums = masked(crc32c(heads)).astype("<u4")
    sums = masked(crc32c(contents)).astype("<u4")
    return [
        head + a.tobytes() + content + b.tobytes()
        for head, a, content, b in zip(heads, head_sums, contents, sums, strict=True)
    ]


def unframed(records: list[bytes]) -> list[bytes]:
    """The payloads of whole records; a wrong length or checksum is an error."""
    contents = [record[_HEAD:-_FOOT] for record in records]
    for record, right in zip(records, framed(contents), strict=True):
        if record != right:
            raise ValueError("a record does not match its length or checksum")
    return contents


def _writer(folder: str, path: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pa.fs.FileSystem.from_uri(folder)
        part = TaskContext.get().partitionId()
        name = f"part-{part:05d}-{uuid.uuid4().hex}.rec"
        encode, schema = tokens.encoder(path, _REMEMBERED).encode, _schema(_INDEX)
        out, place, offset, before = None, 0, 0, 0
        for batch in slices(batches, "text", _AT_ONCE):
            ids = encode(as_bytes(batch.column("text")), end_id)
            doc_ids = batch.column("doc_id").to_pylist()
            records = framed(payloads(ids, doc_ids))
            out = out or files.open_output_stream(f"{root}/{name}")
            out.write(b"".join(records))
            lengths = [len(x) for x in records]
            counts = [len(x) for x in ids]
            offsets = list(accumulate(lengths, initial=offset))
            befores = list(accumulate(counts, initial=before))
            yield record_batch(
                {
                    "file": [name] * len(ids),
                    "part": [part] * len(ids),
                    "place": range(place, place + len(ids)),
                    "doc_id": doc_ids,
                    "offset": offsets[:-1],
                    "length": lengths,
                    "before": befores[:-1],
                    "n_tokens": counts,
                },
                schema,
            )
            place, offset, before = place + len(ids), offsets[-1], befores[-1]
        if out:
            out.close()

    return write


def write_records(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    folder: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Records:
    """Encode every text and write it; ``folder`` must be one that all executors reach."""
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark)}/totelane/records-{uuid.uuid4().hex}"
    folder = folder if ":/" in folder else f"file://{folder}"
    files, root = pa.fs.FileSystem.from_uri(f"{folder}/data")
    files.create_dir(root)
    rows = entries(docs, id_col, text_col).select("doc_id", "text")
    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc()]
    index = (
        rows.repartitionByRange(shuffle_partitions(spark), F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(*order)
        .mapInArrow(_writer(f"{folder}/data", tokenizer, end_id), _INDEX)
    )
    index.write.mode("error").parquet(f"{folder}/index")
    return open_records(spark, folder)


def open_records(spark: SparkSession, folder: str) -> Records:
    return Records(folder, spark.read.schema(_INDEX).parquet(f"{folder}/index"))


def _reader(folder: str, with_ids: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        files, root = pa.fs.FileSystem.from_uri(folder)
        schema, opened, source = _schema(_READ), None, None
        for batch in batches:
            rows = batch.to_pydict()
            for start in range(0, batch.num_rows, 1000):
                own = range(start, min(start + 1000, batch.num_rows))
                records = []
                for i in own:
                    if rows["file"][i] != opened:
                        opened = rows["file"][i]
                        source = files.open_input_file(f"{root}/{opened}")
                    records.append(source.read_at(rows["length"][i], rows["offset"][i]))
                contents = unframed(records)
                ids = [
                    np.frombuffer(x, f"<u{x[0]}", offset=_PREFIX).astype("<u4").tobytes()
                    for x in contents
                ]
                yield record_batch(
                    {
                        "part": [rows["part"][i] for i in own],
                        "doc_id": [
                            int.from_bytes(x[2:_PREFIX], "little", signed=True) if x[1] else None
                            for x in contents
                        ],
                        "before": [rows["before"][i] for i in own],
                        "n_tokens": [len(x) // 4 for x in ids],
                        "ids_crc32": [zlib.crc32(x) for x in ids],
                        "ids": ids if with_ids else [None] * len(ids),
                    },
                    schema,
                )

    return read


def read_records(records: Records, with_ids: bool = True) -> DataFrame:
    """Each record read back through the index: ``doc_id``, ``start`` (ids of all documents
    before it), ``n_tokens``, ``ids_crc32``, ``ids`` (4 bytes each, else null).

    Only the number of ids per file comes to the driver.
    """
    spark = records.index.sparkSession
    sums = records.index.groupBy("part").agg(F.sum("n_tokens")).collect()
    totals = sorted((row[0], row[1]) for row in sums)
    starts = accumulate((n for _, n in totals), initial=0)
    offsets = spark.createDataFrame(
        [(part, start) for (part, _), start in zip(totals, starts, strict=False)],
        "part int, first long",
    )
    return (
        records.index.mapInArrow(_reader(f"{records.folder}/data", with_ids), _READ)
        .join(F.broadcast(offsets), "part")
        .withColumn("start", F.col("first") + F.col("before"))
        .select("doc_id", "start", "n_tokens", "ids_crc32", "ids")
    )
