"""Rules on codes kept as a table of ranges, and the first rule that holds for each code.

Ranges may overlap and be many. Codes and the ends of ranges are put in order together, so a
range covers a run of places. Each run is cut into blocks whose sizes are powers of two, at
most two of a size; a code lies in one block of each size. A code thus meets its rules by equal
blocks, in a join that moves some twenty rows per code or range, and never every pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from totelane.functions import fixed
from totelane.operators.numbering import number_rows
from totelane.session import durable

RULES = "low string, high string, zone string, rank bigint"


def floor_rules(spark: SparkSession) -> DataFrame:
    """The fixed zones of the first floor as such a table; they hold for codes of three."""
    rows = [(low, high, zone, n) for n, (low, high, zone) in enumerate(fixed.FLOOR_ZONES)]
    return spark.createDataFrame(rows, RULES)


def _blocks(first: Column, last: Column, levels: int) -> Column:
    """Blocks (``level``, ``block``) that make up the places from ``first`` to ``last``."""

    def within(level: int) -> tuple[Column, Column]:
        """The first and the last block of a size that lie within the run."""
        size = 1 << level
        return F.ceil(first / size).cast("bigint"), F.floor((last + 1) / size).cast("bigint") - 1

    blocks = []
    for level in range(levels + 1):
        (low, high), (low2, high2) = within(level), within(level + 1)
        # Blocks in the middle are halves of larger ones; one at either end may be left.
        any_here, none_above = low <= high, low2 > high2
        for block, left in ((low, F.floor(low / 2) < low2), (high, F.floor(high / 2) > high2)):
            here = F.struct(F.lit(level).alias("level"), block.alias("block"))
            blocks.append(F.when(any_here & (left | none_above), here))
    return F.array_distinct(F.array_compact(F.array(*blocks)))


def first_rules(codes: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct ``code`` of ``codes`` with the ``zone`` of the rule of lowest rank whose range,
    both ends included, holds it; of equal ranks the first zone by name. Codes without a rule
    have null. Ranges without an end, or with the ends the wrong way round, hold nothing."""
    codes = codes.select("code").filter(F.col("code").isNotNull()).distinct()
    rules = rules.filter(F.col("low") <= F.col("high"))
    points = (
        codes.select(F.col("code").alias("point"))
        .unionByName(rules.select(F.col("low").alias("point")))
        .unionByName(rules.select(F.col("high").alias("point")))
        .distinct()
    )
    placed = durable(number_rows(points, [F.col("point").asc()], "place"))
    most = placed.agg(F.max("place")).first()[0] or 1
    levels = most.bit_length()

    def place_of(point: str, name: str) -> DataFrame:
        return placed.select(F.col("point").alias(point), F.col("place").alias(name))

    runs = rules.join(place_of("low", "first"), "low").join(place_of("high", "last"), "high")
    found = (
        runs.select(
            F.explode(_blocks(F.col("first"), F.col("last"), levels)).alias("at"), "rank", "zone"
        )
        .groupBy("at.level", "at.block")
        .agg(F.min(F.struct("rank", "zone")).alias("rule"))
    )
    held = F.array(
        *(
            F.struct(F.lit(level).alias("level"), F.shiftright("place", level).alias("block"))
            for level in range(levels + 1)
        )
    )
    return (
        codes.join(place_of("code", "place"), "code")
        .select("code", F.explode(held).alias("at"))
        .select("code", "at.*")
        .join(found, ["level", "block"], "left")
        .groupBy("code")
        .agg(F.min("rule").alias("rule"))
        .select("code", F.col("rule.zone").alias("zone"))
    )
