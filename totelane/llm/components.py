"""Connected components by turns of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from totelane.session import durable


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours linked to the smallest of them and itself; large stars move
    the greater neighbours, small ones the rest and the node."""
    if large:
        around = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    least = around.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    moved = around.join(least, "a")
    if large:
        linked = moved.filter("b > a").select(F.col("least").alias("a"), "b")
    else:
        linked = moved.select(F.col("least").alias("a"), "b").unionByName(
            least.select(F.col("least").alias("a"), F.col("a").alias("b"))
        )
    return linked.filter("a < b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest number reachable, of the nodes of links ``a < b``.

    Each turn is written, so a lost executor costs one turn at most. Every node but the root
    ends with one link, to the root; the turns end when nothing changes.
    """
    links, seen = durable(links.distinct()), None
    while True:
        now = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == seen:
            break
        seen = now
        links = durable(_stars(_stars(links, True), False))
    return links.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
