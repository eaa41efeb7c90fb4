"""What is measured before a plan is laid out: hot keys, and the size of the zone map.

An extract that is taken in keeps the sketches of its keys beside its tables, a few rows per
part that was added. A run combines these and reads the large tables for routing only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from totelane.operators.picks import hot_transactions, order_lines
from totelane.operators.skew import HotKeys, hot_keys, sketches, together
from totelane.operators.zones import ZoneLookup
from totelane.session import durable
from totelane.settings import PUTAWAY, RouterSettings
from totelane.sources.warehouse import PIECE, Warehouse, counted_pieces, open_items


@dataclass(frozen=True)
class Measures:
    """``open_items`` is what the hot keys were found in; it is joined as it was measured."""

    zones: ZoneLookup
    lines: HotKeys
    items: dict[str, HotKeys]
    open_items: DataFrame


def hot_items(warehouse: Warehouse, states: Sequence[str], skew) -> dict[str, HotKeys]:
    """Hot orders and products, and hot totes where totes are joined on too."""
    columns = ["inventory_key"] + (["tote_key"] if PUTAWAY in states else [])
    return hot_keys(open_items(warehouse), columns, skew, kept=warehouse.kept.get("items"))[0]


def measured_items(
    warehouse: Warehouse, states: Sequence[str], skew
) -> tuple[DataFrame, dict[str, HotKeys]]:
    """The open items and their hot keys. Where these take a pass over the items, the items are
    written in it, so that whatever they come from is worked out once."""
    if "items" in warehouse.kept:
        return open_items(warehouse), hot_items(warehouse, states, skew)
    written = replace(warehouse, tote_detail=durable(open_items(warehouse)))
    return open_items(written), hot_items(written, states, skew)


def measure(warehouse: Warehouse, settings: RouterSettings) -> Measures:
    zones, lines, (items, hot) = together(
        warehouse.tote_detail.sparkSession,
        lambda: ZoneLookup(warehouse, settings.skew),
        lambda: hot_transactions(warehouse, settings.skew),
        lambda: measured_items(warehouse, settings.states, settings.skew),
    )
    return Measures(zones, lines, hot, items)


#: Keys that a sketch of an extract tracks.
TRACKED = 10_000


def take_in(warehouse: Warehouse, path: str, append: bool = False) -> Warehouse:
    """Store the tables in canonical form at ``path``, or add to those that are there, with
    the sketches of what was added; the whole extract. A call that dies adds nothing."""
    spark = warehouse.tote_detail.sparkSession
    piece, written, finish = warehouse.write_piece(path, append)
    added = Warehouse(**written)
    measured = {
        "lines": sketches(order_lines(added).select("tran_id"), ["tran_id"], TRACKED),
        "items": sketches(
            open_items(added).select("inventory_key", "tote_key"), ["inventory_key", "tote_key"], TRACKED
        ),
    }
    together(
        spark,
        *(
            lambda name=name, rows=rows: rows.write.parquet(f"{path}/measures/{name}/{PIECE}={piece}")
            for name, rows in measured.items()
        ),
    )
    finish()
    return taken_in(spark, path)


def taken_in(spark: SparkSession, path: str) -> Warehouse:
    """The extract at ``path`` with its sketches."""
    stored = Warehouse.read_canonical(spark, path)
    kept = {
        name: counted_pieces(spark.read, path, f"measures/{name}") for name in ("lines", "items")
    }
    return replace(stored, kept=kept)
