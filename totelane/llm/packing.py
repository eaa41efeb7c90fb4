"""Operator 7: best-fit packing with certified counts of sequences.

A document is its token ids and an end id; longer ones than a sequence are cut. Pieces are
packed by best-fit decreasing in partitions of a bounded number of pieces, dealt by a hash so
that each holds a like mix of lengths. Lower bounds from dual-feasible functions of all
lengths together, and of those of each partition, certify the counts. While the whole count
exceeds its bound, partitions exchange documents: every sequence that is not full is handed in,
and whole sequences are dealt to new partitions. A partition whose count meets its own bound is
certified and stays as it is; only other partners can gain it anything. One with a gap is packed
again by best-fit decreasing, and the old packing stays where the new one needs as many. Rounds
end when the whole count meets the bound, or a round saves nothing.

A null text counts as empty: its end id makes a piece. Repeated rows are packed each for
itself. An empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from totelane.llm import tokens
from totelane.llm.common import as_bytes, entries, record_batch, slices
from totelane.session import durable

CAPACITY = 2048
#: Pieces that one task packs together.
PIECES_AT_ONCE = 50_000
_TEXT_AT_ONCE = 1 << 20
_PIECE = "at bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_PACKED = f"{_PIECE}, sequence_id bigint, offset bigint, closed boolean"


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and place of each length, longest first into the fullest bin that has room, and
    the number of bins. Bins are found by a set of the rooms left, kept as bits."""
    bins, places = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, opened = 0, 0
    for i, length in sorted(enumerate(lengths.tolist()), key=lambda x: (-x[1], x[0])):
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            own = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            room, own, opened = capacity, opened, opened + 1
        bins[i], places[i] = own, capacity - room
        left = room - length
        if left:
            with_room[left].append(own)
            rooms |= 1 << left
    return bins, places, opened


def least_bins(counts: np.ndarray, capacity: int) -> int:
    """A bound no packing can beat, from ``counts[length]`` pieces of each length.

    Two families of dual-feasible functions: thresholds, which round long lengths up to the
    capacity and drop short ones, and steps, which round multiples of a share up. Any set of
    lengths that fits the capacity fits it after the function as well.
    """
    lengths = np.arange(len(counts))
    best = -(-int((counts * lengths).sum()) // capacity)
    rows, mass = counts.astype(np.int64), (counts * lengths).astype(np.int64)
    upto, weight = np.cumsum(rows), np.cumsum(mass)
    for least in np.flatnonzero(rows[: capacity // 2 + 1]).tolist() or [1]:
        least = max(least, 1)
        whole = int(upto[-1] - upto[capacity - least])
        between = int(weight[capacity - least] - weight[least - 1])
        best = max(best, whole + -(-between // capacity))
    for k in range(1, 33):
        scaled = (k + 1) * lengths
        exact = scaled % capacity == 0
        value = np.where(exact, lengths * k, scaled // capacity * capacity)  # times k
        best = max(best, -(-int((counts * value).sum()) // (capacity * k)))
    return best


def _cut(path: str, end_id: int, capacity: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        encode = tokens.encoder(path).encode
        names = ["at", "doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
        for batch in slices(batches, "text", _TEXT_AT_ONCE):
            out: dict[str, list] = {name: [] for name in names}
            places, doc_ids = batch.column("at").to_pylist(), batch.column("doc_id").to_pylist()
            found = encode(as_bytes(batch.column("text")), end_id)
            for at, doc_id, ids in zip(places, doc_ids, found, strict=True):
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    own = ids[start : start + capacity].astype("<u4").tobytes()
                    row = (at, doc_id, piece, start, len(own) // 4, zlib.crc32(own), own)
                    for name, value in zip(names, row, strict=False):
                        out[name].append(value)
            kinds = {"piece": pa.int32(), "ids": pa.binary()}
            schema = pa.schema([(name, kinds.get(name, pa.int64())) for name in names])
            yield record_batch(out, schema)

    return cut


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = CAPACITY,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The pieces of each document, with their ids (4 bytes each) if asked for."""
    return entries(docs, id_col, text_col).mapInArrow(
        _cut(tokenizer, end_id, capacity, with_ids), _PIECE + ", ids binary" * with_ids
    )


def certified(lengths: np.ndarray, capacity: int, sequences: int) -> bool:
    """Whether no packing of these pieces needs fewer sequences."""
    return sequences <= least_bins(np.bincount(lengths, minlength=capacity + 1), capacity)


def _placed(rows: pa.Table, ids: np.ndarray, places: np.ndarray, capacity: int) -> pa.Table:
    """The rows with their sequence and place, and whether the sequence is full."""
    distinct, bins = np.unique(ids, return_inverse=True)
    lengths = rows["length"].to_numpy()
    closed = np.bincount(bins, weights=lengths, minlength=len(distinct)) == capacity
    for name in ("sequence_id", "offset", "closed"):
        if name in rows.column_names:
            rows = rows.drop_columns([name])
    return (
        rows.append_column("sequence_id", pa.array(ids))
        .append_column("offset", pa.array(places))
        .append_column("closed", pa.array(closed[bins]))
    )


def _first_round(capacity: int, at_once: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_id, waiting, n = TaskContext.get().partitionId() << 33, [], 0

        def done() -> Iterator[pa.RecordBatch]:
            nonlocal next_id
            table = pa.Table.from_batches(waiting)
            bins, places, opened = best_fit(table["length"].to_numpy(), capacity)
            table = _placed(table, next_id + bins, places, capacity)
            next_id += opened
            yield from table.combine_chunks().to_batches()

        for batch in batches:
            for start in range(0, batch.num_rows, at_once):
                part = batch.slice(start, at_once)
                if waiting and n + part.num_rows > at_once:
                    yield from done()
                    waiting, n = [], 0
                waiting.append(part)
                n += part.num_rows
        if n:
            yield from done()

    return pack


def _again(capacity: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)).drop_columns(["bucket"])
        lengths, used = rows["length"].to_numpy(), np.unique(rows["sequence_id"].to_numpy())
        if not certified(lengths, capacity, len(used)):
            bins, places, n = best_fit(lengths, capacity)
            if n < len(used):
                rows = _placed(rows, used[bins], places, capacity)
        yield from rows.combine_chunks().to_batches()

    return pack


def pack_pieces(
    pieces: DataFrame, capacity: int = CAPACITY, at_once: int | None = None
) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``, ``at_once`` (else ``PIECES_AT_ONCE``)
    packed by a task. ``pieces`` is read several times.

    Only counts by length, at most one per token of the capacity, come to the driver.
    """
    at_once = at_once or PIECES_AT_ONCE
    counts = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    bound = least_bins(counts, capacity)
    # Pieces next to each other are often alike: tables are sorted by source or length.
    mixed = pieces.repartition(max(1, -(-int(counts.sum()) // at_once)), F.xxhash64("at", "piece"))
    rows = durable(mixed.mapInArrow(_first_round(capacity, at_once), _PACKED))
    used = rows.filter("offset = 0").count()
    done: list[DataFrame] = []
    for turn in count(1):
        if used <= bound:
            break
        offered = rows.filter("not closed")
        n, before = offered.agg(
            F.count(F.lit(1)), F.coalesce(F.sum((F.col("offset") == 0).cast("long")), F.lit(0))
        ).first()
        if before < 2:
            break
        done.append(rows.filter("closed"))
        # Sequences go as a whole; a hash of the turn as well, so partners change.
        bucket = F.pmod(F.xxhash64("sequence_id", F.lit(turn)), F.lit(-(-n // at_once)))
        rows = durable(
            offered.withColumn("bucket", bucket)
            .groupBy("bucket")
            .applyInArrow(_again(capacity), _PACKED)
        )
        saved = before - rows.filter("offset = 0").count()
        used -= saved
        if not saved:
            break
    return reduce(DataFrame.unionByName, [*done, rows]).drop("closed")


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY
) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``."""
    pieces = durable(token_pieces(docs, tokenizer, end_id, capacity))
    return pack_pieces(pieces, capacity).drop("at")
