"""Routes kept up to date from a stream of changed pick lines.

For each tote the store counts how many lines lead to each of its zones, so that a line can be
taken away again. A batch of changes is summed up per order and zone, joined with the totes
that hold the order, and added to the counts: only parts of the store with such totes are read
and written, and only their routes are worked out anew. Items, pick transactions and zones are
tables that stay as they are while the stream runs; what batches need of them is written once,
when the planner is made, and not worked out again for every batch.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from totelane.functions import fixed
from totelane.functions.locations import pick_location, spread_zone
from totelane.functions.text import key
from totelane.operators.measures import hot_items
from totelane.operators.routes import one_spelling, planned_routes, tote_routes
from totelane.operators.skew import HotKeys, spread_join, together
from totelane.operators.zones import ZoneLookup
from totelane.session import durable, durable_counted
from totelane.settings import SINGLE, RouterSettings
from totelane.sources.parts import Files, TakenError, parts_of
from totelane.sources.state_store import PARTS, StaleSnapshotError
from totelane.sources.warehouse import Warehouse, open_items

#: ``change`` is 1 for a line that is new, -1 for one that is gone.
CHANGES = "tran_id bigint, order_id string, location_id string, change int"
_COUNTS = "tote_key string, tote_id string, zone string, n bigint"
_ROUTES = ["tote_key", "tote_id", "origroute", "route", "chute", "noncon"]


class ZoneCounts:
    """Versions of the counts, each of them the parts that a batch changed and those it left."""

    def __init__(self, spark: SparkSession, root: str, parts: int = PARTS):
        self.files, self._parts = Files(spark, root), parts

    def newest(self) -> dict:
        names = self.files.names("commits")
        empty = {"version": 0, "batch": -1, "parts": self._parts, "folders": {}}
        found = self.files.read(f"commits/{names[-1]}") if names else empty
        return found | {"folders": {int(n): folder for n, folder in found["folders"].items()}}

    def rows(self, commit: dict, only: list[int] | None = None) -> DataFrame:
        """``tote_key``, ``tote_id``, ``zone``, ``n`` of all parts or of some."""
        return self.files.read_parts(commit["folders"], _COUNTS, only)

    def put(self, before: dict, changed: list[int], rows: DataFrame, batch: int) -> None:
        """``rows`` replace the parts ``changed``; all others stay where they are."""
        version = before["version"] + 1
        folders = {n: x for n, x in before["folders"].items() if n not in set(changed)}
        if changed:
            folder = f"counts/v{version:08d}-{uuid.uuid4().hex[:8]}"
            folders |= self.files.write_parts(rows, "tote_key", before["parts"], folder)
        row = before | {"version": version, "batch": batch, "folders": folders}
        try:
            self.files.put_once(f"commits/v{version:08d}.json", row)
        except TakenError as taken:
            raise StaleSnapshotError(str(taken)) from taken


def counted_zone_sets(counts: DataFrame) -> DataFrame:
    """Per tote with lines left: ``tote_key``, ``tote_id``, ``zones``, as a run plans them."""
    spelt = F.struct(F.upper("zone").alias("key"), "zone")
    return (
        counts.groupBy("tote_key")
        .agg(F.min("tote_id").alias("tote_id"), F.array_sort(F.collect_set(spelt)).alias("spelt"))
        .select("tote_key", "tote_id", one_spelling("spelt").alias("zones"))
    )


def counted_routes(counts: DataFrame) -> DataFrame:
    """The planned route of each tote with lines left."""
    return planned_routes(tote_routes(counted_zone_sets(counts))).select(*_ROUTES)


class IncrementalPlanner:
    """Adds batches of changed lines to the counts in ``root``."""

    def __init__(self, warehouse: Warehouse, settings: RouterSettings, root: str, parts: int = PARTS):
        if settings.states != (SINGLE,):
            raise ValueError("changed lines decide routes of open picks only")
        spark = warehouse.tote_detail.sparkSession
        self._settings, self.counts = settings, ZoneCounts(spark, root, parts)
        picks = warehouse.trans.filter(F.col("tran_type") == fixed.PICK).select("tran_id").distinct()
        # An item that is listed twice counts once.
        items = open_items(warehouse).select("tote_key", "tote_id", "inventory_key").distinct()
        self._zones, self._picks, self._items = together(
            spark,
            lambda: ZoneLookup(warehouse, settings.skew),
            lambda: durable(picks),
            lambda: durable(items),
        )
        listed = replace(warehouse, tote_detail=self._items)
        self._hot: HotKeys = hot_items(listed, settings.states, settings.skew)["inventory_key"]

    def _by_tote(self, changes: DataFrame) -> DataFrame:
        """What the changes add to the counts of the totes they concern."""
        lines = changes.select(
            "tran_id",
            key("order_id").alias("inventory_key"),
            pick_location(key("location_id")).alias("location_key"),
            F.col("change").cast("bigint").alias("n"),
        ).filter(F.col("inventory_key") > "")
        # First per transaction and place: what is looked up does not grow with repeated lines.
        lines = lines.groupBy("tran_id", "inventory_key", "location_key").agg(F.sum("n").alias("n"))
        found = self._zones.add_to(lines.filter("n <> 0").join(self._picks, "tran_id", "left_semi"))
        by_order = (
            found.filter(F.col("zone").isNotNull() | F.col("spread"))
            .groupBy("inventory_key", "zone", "spread")
            .agg(F.sum("n").alias("n"))
        )
        joined = spread_join(self._items, by_order, "inventory_key", "inner", self._hot)
        own = spread_zone(F.col("tote_key"), self._settings.random_mode)
        zone = F.when(F.col("spread"), own).otherwise(F.col("zone"))
        return joined.groupBy("tote_key", "tote_id", zone.alias("zone")).agg(F.sum("n").alias("n"))

    def add(self, changes: DataFrame, batch: int, out: str) -> list[int]:
        """Add a batch once, and write the new routes of totes whose route it changes to
        ``out``, with null for totes that have no line left; the parts it changes."""
        before = self.counts.newest()
        if before["batch"] >= batch:
            return []
        delta = durable(self._by_tote(changes).filter("n <> 0"))
        changed = parts_of(delta, "tote_key", before["parts"])
        stored = self.counts.rows(before, changed)
        totes = delta.select("tote_key").distinct()
        rows, found = durable_counted(
            stored.unionByName(delta)
            .groupBy("tote_key", "tote_id", "zone")
            .agg(F.sum("n").alias("n"))
            .filter("n <> 0"),
            None,
            F.count_if(F.col("n") < 0).alias("negative"),
        )
        if found["negative"]:
            raise ValueError("more lines were taken away than there are")
        old = counted_routes(stored.join(totes, "tote_key", "left_semi"))
        new = counted_routes(rows.join(totes, "tote_key", "left_semi"))
        named = old.select("tote_key", F.col("tote_id").alias("_tote"), F.col("origroute").alias("_old"))
        moved = new.join(named, "tote_key", "full_outer").filter(
            ~F.col("origroute").eqNullSafe(F.col("_old"))
        )
        tote_id = F.coalesce("tote_id", "_tote").alias("tote_id")
        moved.select("tote_key", tote_id, *_ROUTES[2:]).write.mode("overwrite").parquet(f"{out}/batch={batch}")
        self.counts.put(before, changed, rows, batch)
        return changed

    def routes(self) -> DataFrame:
        """The planned routes of all totes, without looking at lines, items or zones."""
        return counted_routes(self.counts.rows(self.counts.newest()))

    def zone_sets(self) -> DataFrame:
        """The zones of all totes, for a ``RoutingRun`` that does not plan them itself."""
        return counted_zone_sets(self.counts.rows(self.counts.newest()))


def follow_changes(
    spark: SparkSession,
    changes_folder: str,
    planner: IncrementalPlanner,
    out: str,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Work off the changes (Parquet) that are there; started again, it goes on from
    ``checkpoint``. A batch that is repeated is not added again."""
    changes = (
        spark.readStream.schema(CHANGES)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(changes_folder)
    )

    def add(batch: DataFrame, batch_id: int) -> None:
        planner.add(batch, batch_id, out)

    writer = changes.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
