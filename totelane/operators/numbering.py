"""Running numbers over a whole table without sorting it in one task."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from totelane.session import durable

_ROW_BITS = 33


def number_rows(
    df: DataFrame, order_by: list[Column], name: str, path: str | None = None
) -> DataFrame:
    """``df`` with its row number, from 1, in the order given; ``order_by`` must be unique.

    The rows are sorted across range partitions and written once, with their partition and
    place in it. A row's number is its place plus the sizes of the partitions before, and the
    sizes are one number per partition. Writing first matters: range bounds are sampled, so
    a second evaluation could cut the ranges elsewhere.
    """
    slot = F.monotonically_increasing_id()
    placed = durable(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_part", F.shiftright(slot, _ROW_BITS).cast("int"))
        .withColumn("_place", slot.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))),
        path,
    )
    counted = placed.groupBy("_part").count().collect()
    sizes = sorted((row["_part"], row["count"]) for row in counted)
    before = list(accumulate((size for _, size in sizes), initial=0))
    offsets = df.sparkSession.createDataFrame(
        [(part, offset) for (part, _), offset in zip(sizes, before, strict=False)],
        "_part int, _before long",
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_place") + 1)
        .drop("_part", "_place", "_before")
    )
