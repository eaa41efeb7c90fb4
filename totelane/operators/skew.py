"""Joins that stay balanced when one key holds a large share of the rows.

Hot keys are found in one pass with a bounded sketch. If there are none, the join is an
ordinary one. Otherwise each hot key is split over as many tasks as its share calls for, and
the few rows of the other side that carry it are repeated once per split. Every row is kept;
a key the sketch misses is joined like any other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from totelane.settings import SkewSettings

HotKeys = list[tuple[str | int | None, int]]

_TRACKED = 10_000
_MOST_TRACKED = 1_000_000
# Groups that sketches are merged in, first and last.
_GROUPS, _LAST_GROUPS = 4096, 64
# Pieces per fair share. Pieces are placed by hash, and with few of them several may meet in
# one task; more are cheap, since only the few rows opposite are repeated.
_PIECES = 4
_LEFT_JOINS = ("inner", "left", "left_semi", "left_anti")


def together(spark: SparkSession, *jobs: Callable) -> list:
    """Results of small jobs that do not depend on each other, run at the same time."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [job.result() for job in started]


def sketches(df: DataFrame, columns: Sequence[str], tracked: int, greatest: str | None = None) -> DataFrame:
    """One row per group of groups of scan partitions: ``_rows``, a sketch per column, and the
    ``greatest`` of a column. A task merges the sketches of the scan partitions that agree in
    their number modulo ``_GROUPS``, then of ``_GROUPS / _LAST_GROUPS`` groups, so what one
    task reads does not grow with the scan up to ``_GROUPS`` partitions, and slowly beyond.
    """
    most = [F.max(greatest).alias("_greatest")] if greatest else []
    first = [F.expr(f"approx_top_k_accumulate(`{c}`, {tracked})").alias(f"_{c}") for c in columns]
    merged = [F.expr(f"approx_top_k_combine(`_{c}`, {tracked})").alias(f"_{c}") for c in columns]
    groups = (
        df.withColumn("_group", F.spark_partition_id() % _GROUPS)
        .groupBy("_group")
        .agg(F.count(F.lit(1)).alias("_rows"), *first, *most)
    )
    again = [F.max("_greatest").alias("_greatest")] if greatest else []
    return groups.groupBy((F.col("_group") % _LAST_GROUPS).alias("_last")).agg(
        F.sum("_rows").alias("_rows"), *merged, *again
    )


def hot_keys(
    df: DataFrame,
    columns: Sequence[str],
    skew: SkewSettings,
    greatest: str | None = None,
    kept: DataFrame | None = None,
) -> tuple[dict[str, HotKeys], Row]:
    """Per column, its hot keys and the number of splits each should get; beside it a row
    with ``_rows`` and the ``_greatest`` value of a column, which come from the same pass.
    ``kept``, the ``sketches`` of ``df`` from earlier passes, saves the pass.

    With P shuffle partitions at most P keys can hold more than 1/P of the rows each, so
    the lists are short whatever the size of ``df``.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top = min(partitions, _MOST_TRACKED)
    tracked = min(max(_TRACKED, 10 * partitions), _MOST_TRACKED)
    # At most _LAST_GROUPS rows meet in the last task.
    whole = [
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(`_{c}`, {tracked}), {top})").alias(c)
        for c in columns
    ]
    most = [F.max("_greatest").alias("_greatest")] if greatest else []
    parts = kept
    if parts is None:
        parts = sketches(
            df.select(*{*columns, *([greatest] if greatest else [])}), columns, tracked, greatest
        )
    if parts.isEmpty():
        return {name: [] for name in columns}, Row(_rows=0, _greatest=None)
    # Grouped, if only by a constant: sketches cannot be merged in a partition without any.
    found = parts.groupBy(F.lit(0).alias("_all")).agg(F.sum("_rows").alias("_rows"), *whole, *most).first()
    share = max(1, skew.min_rows, int(skew.fair_shares * found["_rows"] / partitions))
    hot = {
        name: [
            (top["item"], -(-_PIECES * top["count"] // share))
            for top in found[name] or []
            if top["count"] > share
        ]
        for name in columns
    }
    return hot, found


def spread_join(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str, hot: HotKeys
) -> DataFrame:
    """Join on the columns ``on``; the hot values of the first one are split on the left.

    Rows are split by the hash of their other columns and, since copies of a row agree in
    these, of the partition they are read in. A task that is run again reads the same
    partition and splits it the same way.
    """
    if how not in _LEFT_JOINS:
        raise ValueError(f"cannot split keys of a {how} join")
    names = [on] if isinstance(on, str) else list(on)
    if not hot:
        return left.join(right, names, how)

    first = names[0]
    others = [name for name in left.columns if name not in names]
    kind = left.schema[first].dataType.simpleString()
    named = [(key, splits) for key, splits in hot if key is not None]
    blanks = next((splits for key, splits in hot if key is None), 1)
    # As many rows as there are hot keys, see hot_keys.
    splits = F.broadcast(
        left.sparkSession.createDataFrame(named, f"{first} {kind}, _splits bigint")
    )
    ways = F.when(F.col(first).isNull(), F.lit(blanks)).otherwise(
        F.coalesce("_splits", F.lit(1))
    )
    salted = left.join(splits, first, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*others, F.spark_partition_id()), ways)
    )
    repeated = right.join(splits, first, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_splits", F.lit(1)) - 1))
    )
    joined = salted.drop("_splits").join(repeated.drop("_splits"), [*names, "_salt"], how)
    return joined.drop("_salt")


def fits_broadcast(table: DataFrame, skew: SkewSettings) -> bool:
    """Whether a lookup table is within the bounds for sending it to every executor.

    Rows and bytes are summed up where they are; only the sums travel.
    """
    texts = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in table.columns]
    size = table.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(reduce(Column.__add__, texts)).alias("bytes")
    ).first()
    return size["rows"] <= skew.broadcast_rows and (size["bytes"] or 0) <= skew.broadcast_bytes


class Lookup:
    """A table with unique keys that many rows are looked up in.

    Its size is measured once. Within the bound it is broadcast and the rows stay where they
    are; beyond it the rows are shuffled to it with their hot keys split.
    """

    def __init__(self, table: DataFrame, on: str, skew: SkewSettings):
        self.table, self.on, self.skew = table, on, skew
        self.small = fits_broadcast(table, skew)

    def add_to(self, rows: DataFrame, how: str = "left") -> DataFrame:
        if self.small:
            return rows.join(F.broadcast(self.table), self.on, how)
        hot, _ = hot_keys(rows, [self.on], self.skew)
        return spread_join(rows, self.table, self.on, how, hot[self.on])
