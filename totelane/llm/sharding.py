"""Operator 2: shards of near equal bytes by Karmarkar-Karp differencing.

Documents with equal texts are one indivisible group. Groups are dealt to buckets of a
bounded number of groups; in each, the two partial partitions of largest spread are combined
in opposite order until one is left, which divides the bucket into bundles. Bundles are the
groups of the next level, until they fit one bucket, which is divided into the shards.
Groups of more than an eighth of a shard, at most eight per shard, and those of one bucket
go up as they are: the bundles make up for the large ones, the small ones for the bundles.

A null text counts as empty. Rows of an empty table give an empty result; a shard may stay
empty when there are fewer groups than shards. Repeated rows belong to one group. Ties are
resolved by the order of group keys, so a run on the same table gives the same shards.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from totelane.llm.common import entries, hot_groups
from totelane.operators.numbering import number_rows
from totelane.operators.skew import spread_join
from totelane.session import durable

#: Groups that one task divides, and the bundles it makes of them per shard.
GROUPS_AT_ONCE = 20_000
BUNDLES_PER_SHARD = 4
#: Bytes that a document takes beside its text.
OVERHEAD = 16


def differencing(sizes: np.ndarray, parts: int) -> np.ndarray:
    """The part of each size, by multi-way differencing.

    A partial partition is a vector of sums, ascending and less their minimum. Combining two
    adds one to the reverse of the other; the sort that follows is remembered, and the way
    back from the last partition gives each size its part.
    """
    n = len(sizes)
    if n == 0 or parts == 1:
        return np.zeros(n, dtype=np.int64)
    sums: dict[int, np.ndarray] = {}
    heap: list[tuple[int, int]] = []
    for i in range(n):
        first = np.zeros(parts, dtype=np.int64)
        first[-1] = sizes[i]
        sums[i] = first
        heap.append((-int(sizes[i]), i))
    heapq.heapify(heap)
    combined: list[tuple[int, int, np.ndarray]] = []
    for node in range(n, 2 * n - 1):
        _, left = heapq.heappop(heap)
        _, right = heapq.heappop(heap)
        total = sums.pop(left) + sums.pop(right)[::-1]
        order = np.argsort(total, kind="stable")
        total = total[order]
        total -= total[0]
        sums[node] = total
        combined.append((left, right, order))
        heapq.heappush(heap, (-int(total[-1]), node))
    part_of = {2 * n - 2: np.arange(parts)}
    for node in range(2 * n - 2, n - 1, -1):
        left, right, order = combined[node - n]
        own = part_of.pop(node)
        of_left = np.empty(parts, dtype=np.int64)
        of_left[order] = own
        part_of[left], part_of[right] = of_left, of_left[::-1]
    return np.array([part_of[i][-1] for i in range(n)], dtype=np.int64)


def _divide(parts: int):
    def divide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)).sort_by("item")
        bucket = rows["bucket"][0].as_py()
        part = differencing(rows["bytes"].to_numpy(), parts)
        yield pa.RecordBatch.from_arrays(
            [rows["item"].combine_chunks(), pa.array(bucket * parts + part, pa.int64())],
            names=["item", "part"],
        )

    return divide


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("item"), F.lit(buckets))


def _divided(items: DataFrame, buckets: int, parts: int) -> DataFrame:
    kind = items.schema["item"].dataType.simpleString()
    dealt = items.withColumn("bucket", _bucket(buckets))
    return durable(dealt.groupBy("bucket").applyInArrow(_divide(parts), f"item {kind}, part bigint"))


def shard_groups(groups: DataFrame, shards: int, at_once: int = GROUPS_AT_ONCE) -> DataFrame:
    """``item`` and ``shard`` of groups with distinct ``item`` (a text) and ``bytes``."""
    total, items = groups.agg(F.sum("bytes"), F.count(F.lit(1))).first()
    parts = shards * BUNDLES_PER_SHARD
    if items <= 2 * max(at_once, parts):
        return _divided(groups, 1, shards).withColumnRenamed("part", "shard")
    buckets = -(-items // at_once)
    heavy = F.col("bytes") > (total or 0) // (8 * shards)
    single = heavy | (_bucket(buckets) == 0)
    bundled = _divided(groups.filter(~single), buckets, parts)
    # A bundle has the number of its part, a single group its own name.
    numbered = bundled.select("item", F.concat(F.lit("="), "part").alias("above"))
    renamed = groups.filter(single).select("item", F.concat(F.lit("+"), "item").alias("above"))
    upper = numbered.unionByName(renamed)
    sums = groups.join(upper, "item").groupBy("above").agg(F.sum("bytes").alias("bytes"))
    placed = shard_groups(durable(sums.withColumnRenamed("above", "item")), shards, at_once)
    return upper.join(placed.withColumnRenamed("item", "above"), "above").select("item", "shard")


def shard_documents(
    docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard`` and ``slot`` of each row."""
    rows = entries(docs, id_col, text_col).select(
        "at",
        "doc_id",
        (F.octet_length("text") + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.sha2("text", 256).alias("item"),
    )
    rows = durable(rows)
    groups = durable(
        rows.groupBy("item").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    )
    placed = shard_groups(groups.select("item", "bytes"), shards)
    hot = hot_groups(groups, "item")
    sharded = durable(spread_join(rows, placed, "item", "inner", hot).drop("item"))
    order = [F.col("shard"), F.col("doc_id").asc_nulls_first(), F.col("at")]
    numbered = number_rows(sharded, order, "_number")
    first = numbered.groupBy("shard").agg(F.min("_number").alias("_first"))  # a row per shard
    return numbered.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.col("shard").cast("int").alias("shard"),
        (F.col("_number") - F.col("_first")).alias("slot"),
    )
