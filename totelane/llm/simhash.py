"""Operator 4: near duplicates of 64-bit fingerprints by Golay-code fuzzy hashing.

A fingerprint is cut into segments of 22, 21 and 21 bits, each a word of the perfect (23,12)
Golay code with zeros in front. A word and the words one bit away decode to at most six
codewords; two words one bit apart share the codeword that either of them decodes to. Of two
fingerprints at most three bits apart,

* either two segments differ in one bit at most together, so one is equal and the codeword
  of the other is among those around it (six ordered pairs of segments),
* or each segment differs in one bit, so the codewords of the first two are among those
  around them and one half of the third segment is equal (two halves).

An entry has one key for each of these eight ways, a search all keys around it; equal keys
are joined and the bits counted. Only distinct fingerprints are joined: copies are one
member. A set of distinct fingerprints pairwise within three bits has at most 128 members
(Kleitman's bound), so links stay in proportion to the fingerprints.

Texts without words have fingerprint zero; a null text counts as empty. Ids that are null
never name a component. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from totelane.llm.common import as_bytes, entries, hot_groups, slices
from totelane.llm.components import components
from totelane.operators.skew import spread_join
from totelane.session import durable

SHINGLE = 3
MOST_BITS = 3
SEED = 42
_AT_ONCE = 1 << 21

# Fixed values of the code: generator polynomial, length and dimension.
_GENERATOR = 0b101011100011
_LENGTH, _DIMENSION = 23, 12
#: Lowest bit and width of the segments.
_SEGMENTS = ((42, 22), (21, 21), (0, 21))
#: The halves of the last segment.
_HALVES = ((0, 11), (11, 10))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bitwise majority over the hashes of the shingles; ties and no words give zeros."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(x) + 1 for x in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(shingle, len(words))
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
    hashed = xxhash.xxh64_intdigest
    hashes = np.array([hashed(joined[a:b], SEED) for a, b in spans], dtype=">u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
    most = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int.from_bytes(np.packbits(most).tobytes(), "big")


def _fingerprints(shingle: int):
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _AT_ONCE):
            found = [fingerprint(x, shingle) for x in as_bytes(batch.column("text"))]
            bits = np.array(found, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("at"), batch.column("doc_id"), pa.array(bits)],
                names=["at", "doc_id", "bits"],
            )

    return compute


@lru_cache(maxsize=1)
def decoder() -> np.ndarray:
    """The number of the nearest codeword of each word."""
    numbers = np.arange(1 << _DIMENSION, dtype=np.int64)
    checks = _LENGTH - _DIMENSION
    remainder = numbers << checks
    for bit in range(_LENGTH - 1, checks - 1, -1):
        high = (remainder >> bit) & 1
        remainder ^= high * (_GENERATOR << (bit - checks))
    words = (numbers << checks) | remainder
    table = np.empty(1 << _LENGTH, dtype=np.uint16)
    for weight in range(4):
        for places in combinations(range(_LENGTH), weight):
            table[words ^ sum(1 << place for place in places)] = numbers
    return table


def _around(segment: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Codewords of the words within one bit, as (row, codeword) pairs without repeats."""
    flips = np.concatenate([[0], 1 << np.arange(width)])
    found = np.sort(decoder()[segment[:, None] ^ flips[None, :]], axis=1)
    new = np.ones(found.shape, dtype=bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    rows, places = np.nonzero(new)
    return rows, found[rows, places].astype(np.int64)


def _pairs(rows_a, words_a, rows_b, words_b, n: int):
    """Both codewords of each row in every combination; rows are ascending."""
    counts = np.bincount(rows_b, minlength=n)
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    repeat = counts[rows_a]
    within = np.arange(repeat.sum()) - np.repeat(np.cumsum(repeat) - repeat, repeat)
    other = np.repeat(starts[rows_a], repeat) + within
    return np.repeat(rows_a, repeat), np.repeat(words_a, repeat), words_b[other]


def keys(bits: np.ndarray, search: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of fingerprints: one key for each way, or all around them for a search."""
    n = len(bits)
    parts = [
        ((bits >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64)
        for low, width in _SEGMENTS
    ]
    if search:
        near = [_around(part, width) for part, (_, width) in zip(parts, _SEGMENTS, strict=True)]
    else:
        near = [(np.arange(n), decoder()[part].astype(np.int64)) for part in parts]
    rows, found, way = [], [], 0
    for equal in range(3):
        for other in range(3):
            if equal == other:
                continue
            own, words = near[other]
            rows.append(own)
            found.append((way << 58) | (parts[equal][own] << _DIMENSION) | words)
            way += 1
    both, first, second = _pairs(*near[0], *near[1], n)
    for low, width in _HALVES:
        half = (parts[2][both] >> low) & ((1 << width) - 1)
        rows.append(both)
        found.append((way << 58) | (half << 2 * _DIMENSION) | (first << _DIMENSION) | second)
        way += 1
    return np.concatenate(rows), np.concatenate(found)


def _keyed(search: bool):
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 5000):
                bits = batch.column("bits").slice(start, 5000).to_numpy()
                rows, found = keys(bits.view(np.uint64), search)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), pa.array(bits[rows])], names=["key", "bits"]
                )

    return compute


def near_links(distinct: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """Links ``a < b`` between the distinct ``bits`` that differ in ``most_bits`` or fewer."""
    if not 0 <= most_bits <= MOST_BITS:
        raise ValueError(f"the keys find up to {MOST_BITS} differing bits")
    bits = distinct.select("bits")
    entry = bits.mapInArrow(_keyed(False), "key bigint, bits bigint")
    search = bits.mapInArrow(_keyed(True), "key bigint, bits bigint")
    apart = F.bit_count(F.col("e.bits").bitwiseXOR(F.col("s.bits")))
    # A planner takes the keys of a small table for small too, and would broadcast them.
    met = entry.alias("e").join(
        search.alias("s").hint("merge"),
        (F.col("e.key") == F.col("s.key"))
        & (F.col("e.bits") != F.col("s.bits"))
        & (apart <= most_bits),
    )
    return met.select(
        F.least("e.bits", "s.bits").alias("a"), F.greatest("e.bits", "s.bits").alias("b")
    ).distinct()


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    most_bits: int = MOST_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``at``, ``doc_id``, ``fingerprint``, ``component_id`` and ``cluster`` of each row; the
    cluster is a number of the component that is never null."""
    rows = durable(
        entries(docs, id_col, text_col).mapInArrow(
            _fingerprints(shingle), "at bigint, doc_id bigint, bits bigint"
        )
    )
    members = durable(
        rows.groupBy("bits").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least_id"))
    )
    roots = components(near_links(members, most_bits)).withColumnRenamed("node", "bits")
    named = members.join(roots, "bits", "left").withColumn(
        "cluster", F.coalesce("root", "bits")
    )
    named = durable(named.select("bits", "cluster", "n", "least_id"))
    linked = named.filter("cluster != bits").select("cluster").distinct()
    together = (
        named.join(linked, "cluster", "left_semi")
        .groupBy("cluster")
        .agg(F.min("least_id").alias("component_id"))
    )
    named = named.join(together, "cluster", "left").select(
        "bits", "cluster", F.coalesce("component_id", "least_id").alias("component_id")
    )
    return spread_join(rows, named, "bits", "inner", hot_groups(members, "bits")).select(
        "at",
        "doc_id",
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        "component_id",
        "cluster",
    )


def first_of_each(found: DataFrame) -> DataFrame:
    """``at`` of one row per cluster: of the smallest doc_id, nulls last, then first read."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "at"))
    return found.groupBy("cluster").agg(first.alias("first")).select("first.at")
