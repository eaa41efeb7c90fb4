"""Blocks of documents that ask the whole corpus about the keys they hold.

Keys such as hashes of word windows are too many to send one by one. A block, rows of a scan
up to a bound of bytes that are written once with its number, sends each of its distinct keys once, sorted and packed, to the
bucket of the key; so a key that every document holds costs a bucket one entry per block.
The bucket answers each block, and the rows of the block, packed as well, meet the answers.
Blocks and buckets are bounded; nothing is gathered per key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from totelane.llm.common import byte_lengths, shuffle_partitions
from totelane.session import durable

#: Bytes of text in a block, unless a single row has more.
BLOCK_BYTES = 8 << 20
_PART_BITS = 24
Asker = Callable[[int, pa.Table], Iterator[pa.RecordBatch]]


def packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unpacked(blob: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype)


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending unsigned keys, as steps from one to the next."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(blob: bytes) -> np.ndarray:
    return np.cumsum(unpacked(blob, "<u8"), dtype=np.uint64)


def buckets_for(rows: DataFrame) -> int:
    """Buckets of keys: several per shuffle partition, so that hashing deals them evenly."""
    return 4 * shuffle_partitions(rows.sparkSession)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of hashes, ascending with them."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def by_bucket(buckets: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal buckets in ascending ones."""
    cuts = np.flatnonzero(np.diff(buckets)) + 1
    for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), len(buckets)], strict=True):
        if stop > start:
            yield int(buckets[start]), slice(start, stop)


def _blocks(
    batches: Iterator[pa.RecordBatch], weight: str, most: int
) -> Iterator[tuple[int, pa.Table]]:
    """Consecutive rows of the task's partition, with a number that only they have."""
    number = TaskContext.get().partitionId() << _PART_BITS
    waiting: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        start, lengths = 0, byte_lengths(batch.column(weight)).tolist()
        for i, length in enumerate(lengths):
            if size and size + length > most:
                if i > start:
                    waiting.append(batch.slice(start, i - start))
                yield number, pa.Table.from_batches(waiting)
                number, waiting, size, start = number + 1, [], 0, i
            size += length
        if start < len(lengths):
            waiting.append(batch.slice(start))
    if waiting:
        yield number, pa.Table.from_batches(waiting)


def asked(blocks: DataFrame, ask: Asker, schema: str) -> DataFrame:
    """What ``ask(block, table)`` yields for each of the ``block_rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from ask(batch["block"][i].as_py(), rows_of(batch["rows"][i].as_py()))

    return blocks.mapInArrow(run, schema)


def _as_row(number: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=4))
    with pa.ipc.new_stream(sink, table.schema, options=options) as out:
        out.write_table(table)
    yield pa.RecordBatch.from_arrays(
        [pa.array([number]), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
        names=["block", "rows"],
    )


def block_rows(rows: DataFrame, weight: str, most: int = BLOCK_BYTES) -> DataFrame:
    """A row per block: its number and its rows, packed. Written once: another scan of
    ``rows`` could be split into other blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in _blocks(batches, weight, most):
            yield from _as_row(number, table)

    return durable(rows.mapInArrow(run, "block bigint, rows binary"))


def rows_of(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(blob)).read_all()


class Table:
    """Places of distinct 64-bit keys, found for many at once by open addressing."""

    def __init__(self, keys: np.ndarray):
        self._bits = np.uint64(64 - max(4, int(2 * len(keys)).bit_length()))
        self._mask = (1 << (64 - int(self._bits))) - 1
        self._keys = np.append(keys, np.uint64(0))
        self._slots = np.full(self._mask + 1, -1, np.int64)
        left, slot = np.arange(len(keys)), self._first(keys)
        while len(left):
            free = self._slots[slot] < 0
            self._slots[slot[free]] = left[free]  # of several for a slot, the last gets it
            placed = self._slots[slot] == left
            left, slot = left[~placed], (slot[~placed] + 1) & self._mask

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self._bits).astype(np.int64)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key among those of the table, or -1."""
        slot = self._first(keys)
        found = self._slots[slot]
        left = np.flatnonzero((found >= 0) & (self._keys[found] != keys))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & self._mask
            next_found = self._slots[slot]
            found[left] = next_found
            other = (next_found >= 0) & (self._keys[next_found] != keys[left])
            left, slot = left[other], slot[other]
        return found
