"""Where the goods in a tote have to go: a fallback over seven levels.

    1  location of an open pick for the order in the tote
    2  target of a replenishment of the tote
    3  location of a put-away of the tote
    4  location of a put-away of the item
    5  home location of the item
    6  rule on the status of the order
    7  hospital

A level is used when every level before it has no row or a row without a location. Several
rows on one level give several destinations. Each level is reduced to one row per key before
it meets the totes, so rows on different levels never multiply.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from totelane.functions import fixed
from totelane.functions.locations import order_destination
from totelane.operators.measures import Measures
from totelane.operators.picks import pick_lines
from totelane.operators.skew import HotKeys, hot_keys, spread_join
from totelane.session import durable
from totelane.settings import PUTAWAY, SINGLE, SkewSettings
from totelane.sources.warehouse import Warehouse, open_items

ITEM_LEVELS = (1, 4, 5, 6)
TOTE_LEVELS = (2, 3)
LAST_LEVEL = 7


def level_rows(warehouse: Warehouse, levels: Sequence[int], hot_lines: HotKeys) -> DataFrame:
    """``key``, ``level``, ``location_key`` (NULL where a row has no location)."""

    def moves(kind: str, location: str) -> DataFrame:
        return warehouse.trans.filter(
            (F.col("tran_type") == kind) & (F.col("inventory_key") > "")
        ).select(F.col("inventory_key").alias("key"), F.col(location).alias("location_key"))

    def rows(level: int) -> DataFrame:
        if level == 1:
            return pick_lines(warehouse, hot_lines).withColumnRenamed("order_key", "key")
        if level == 2:
            return moves(fixed.REPLENISH, "to_location_key")
        if level in (3, 4):
            return moves(fixed.PUT_AWAY, "location_key")
        if level == 5:
            return warehouse.multi_home_loc.withColumnRenamed("product_key", "key")
        return warehouse.orders.select(
            F.col("order_key").alias("key"),
            order_destination(F.col("status_key")).alias("location_key"),
        )

    parts = [rows(n).select("key", F.lit(n).alias("level"), "location_key") for n in levels]
    return reduce(DataFrame.unionByName, parts)


def _flags_by_key(rows: DataFrame, levels: Sequence[int], key: str) -> DataFrame:
    """One row per key. For each level n: ``used_n`` it has a location, ``open_n`` the next
    level counts too."""
    blank = F.col("location_key").isNull()
    columns = []
    for n in levels:
        here = F.col("level") == n
        columns += [
            F.bool_or(here & ~blank).alias(f"used_{n}"),
            (~F.bool_or(here) | F.bool_or(here & blank)).alias(f"open_{n}"),
        ]
    return rows.filter(F.col("key").isNotNull()).groupBy(F.col("key").alias(key)).agg(*columns)


def _zones_by_key(rows: DataFrame, levels: Sequence[int], key: str) -> DataFrame:
    """The flags of ``_flags_by_key`` and for each level ``zones_n`` and ``spread_n``.

    A key is reduced to one set of levels and zones, in the tasks that read its rows as well
    as after the shuffle, so it is never longer than levels times zones. The columns are then
    read off the set; one set is about half the work of one per level.
    """
    found = (
        rows.filter(F.col("key").isNotNull())
        .groupBy(F.col("key").alias(key))
        .agg(F.collect_set(F.struct("level", "zone", "spread")).alias("found"))
    )

    def blank(entry: Column) -> Column:
        return entry["zone"].isNull() & ~entry["spread"]

    def at(level: int) -> Column:
        if len(levels) == 1:
            return F.col("found")
        return F.filter("found", lambda entry: entry["level"] == level)

    columns = []
    for n in levels:
        here = at(n)
        columns += [
            F.exists(here, lambda entry: ~blank(entry)).alias(f"used_{n}"),
            ((F.size(here) == 0) | F.exists(here, blank)).alias(f"open_{n}"),
            F.array_compact(F.transform(here, lambda entry: entry["zone"])).alias(f"zones_{n}"),
            F.exists(here, lambda entry: entry["spread"]).alias(f"spread_{n}"),
        ]
    return found.select(key, *columns)


def _reached(level: int) -> Column:
    """Whether the fallback gets to a level; an unmatched key leaves its levels open."""
    before = [F.coalesce(F.col(f"open_{n}"), F.lit(True)) for n in range(1, level)]
    return reduce(Column.__and__, before, F.lit(True))


def _wanted(states: Sequence[str]) -> list[int]:
    """Levels whose destinations are kept: picks are SINGLE, all others PUTAWAY."""
    picks = [1] if SINGLE in states else []
    return picks + (list(range(2, LAST_LEVEL + 1)) if PUTAWAY in states else [])


def _fallback(
    items: DataFrame,
    by_item: DataFrame,
    by_tote: DataFrame | None,
    hot: dict[str, HotKeys],
) -> DataFrame:
    """Items beside the levels of their order or product and of their tote."""
    if by_tote is None:
        return spread_join(items, by_item, "inventory_key", "inner", hot["inventory_key"])
    beside_items = spread_join(items, by_item, "inventory_key", "left", hot["inventory_key"])
    return spread_join(beside_items, by_tote, "tote_key", "left", hot["tote_key"])


def item_zones(warehouse: Warehouse, states: Sequence[str], measures: Measures) -> DataFrame:
    """Per item in a tote: ``zones`` (distinct, not empty unless ``spread``), ``spread``.

    Locations become zones before totes are joined, so that what is joined to an item is as
    short as the list of zones, however many pick lines its order has.
    """
    zones, hot, items = measures.zones, measures.items, measures.open_items
    wanted = _wanted(states)
    item_levels = ITEM_LEVELS if PUTAWAY in states else (1,)

    def summary(levels: Sequence[int], key: str) -> DataFrame:
        rows = zones.add_to(level_rows(warehouse, levels, measures.lines))
        return _zones_by_key(rows, levels, key)

    by_item = summary(item_levels, "inventory_key")
    if PUTAWAY not in states:
        found = _fallback(items, by_item.filter("used_1"), None, hot)
        zones_found, spread = F.col("zones_1").alias("zones"), F.col("spread_1").alias("spread")
        return found.select("tote_id", "tote_key", zones_found, spread)

    everything = _fallback(items, by_item, summary(TOTE_LEVELS, "tote_key"), hot)
    none = F.array().cast("array<string>")
    hospital = F.array(F.lit(zones.of_location(fixed.HOSPITAL_LOCATION)))

    def found_at(n: int) -> Column:
        return hospital if n == LAST_LEVEL else F.coalesce(F.col(f"zones_{n}"), none)

    listed = F.concat(*[F.when(_reached(n), found_at(n)).otherwise(none) for n in wanted])
    spreads = [
        _reached(n) & F.coalesce(F.col(f"spread_{n}"), F.lit(False))
        for n in wanted
        if n != LAST_LEVEL
    ]
    spread = reduce(Column.__or__, spreads)
    return everything.select(
        "tote_id", "tote_key", listed.alias("zones"), spread.alias("spread")
    ).filter(F.col("spread") | (F.size("zones") > 0))


def tote_destinations(
    warehouse: Warehouse,
    states: Sequence[str],
    hot_lines: HotKeys,
    hot: dict[str, HotKeys],
    skew: SkewSettings,
) -> DataFrame:
    """Distinct ``tote_key``, ``inventory_key``, ``tote_state``, ``dest_level`` and
    ``location_key``: the destinations themselves, for inspection.

    Routing does not go through them, see ``item_zones``: an order with many locations gives
    as many rows here for each of its totes.
    """
    items = open_items(warehouse).select("tote_key", "inventory_key").distinct()
    # Written once: the flags and the locations themselves both start from them.
    by_item_rows = durable(level_rows(warehouse, ITEM_LEVELS, hot_lines).distinct())
    by_tote_rows = durable(level_rows(warehouse, TOTE_LEVELS, hot_lines).distinct())
    everything = _fallback(
        items,
        _flags_by_key(by_item_rows, ITEM_LEVELS, "inventory_key"),
        _flags_by_key(by_tote_rows, TOTE_LEVELS, "tote_key"),
        hot,
    )

    def wish(n: int) -> Column:
        used = F.lit(True) if n == LAST_LEVEL else F.coalesce(F.col(f"used_{n}"), F.lit(False))
        return F.when(_reached(n) & used, F.lit(n))

    levels = F.array_compact(F.array(*[wish(n) for n in _wanted(states)]))
    of_tote = F.col("dest_level").isin(*TOTE_LEVELS)
    wishes = everything.select(
        "tote_key", "inventory_key", F.explode(levels).alias("dest_level")
    ).withColumn("key", F.when(of_tote, F.col("tote_key")).otherwise(F.col("inventory_key")))
    located = (
        by_item_rows.unionByName(by_tote_rows)
        .filter(F.col("location_key").isNotNull())
        .select(F.col("level").alias("dest_level"), "key", "location_key")
    )
    # A wish for a level but the last has a location for certain.
    last = F.col("dest_level") == LAST_LEVEL
    both = _largest(hot["inventory_key"] + hot["tote_key"])
    found = _located(wishes.filter(~last), located, both, skew).unionByName(
        wishes.filter(last).withColumn("location_key", F.lit(fixed.HOSPITAL_LOCATION))
    )
    return found.select(
        "tote_key",
        "inventory_key",
        F.when(F.col("dest_level") == 1, SINGLE).otherwise(PUTAWAY).alias("tote_state"),
        "dest_level",
        "location_key",
    )


def _located(wishes: DataFrame, located: DataFrame, hot: HotKeys, skew: SkewSettings) -> DataFrame:
    """The wishes with their locations. Keys with very many locations are split on that side,
    all others on the side of the wishes."""
    on = ["key", "dest_level"]
    many = [(key, splits) for key, splits in hot_keys(located, ["key"], skew)[0]["key"] if key is not None]
    if not many:
        return spread_join(wishes, located, on, "inner", hot)
    # As many keys as there are shuffle partitions, see hot_keys.
    there = F.col("key").isin(*(key for key, _ in many))
    few = spread_join(wishes.filter(~there), located.filter(~there), on, "inner", hot)
    wide = spread_join(located.filter(there), wishes.filter(there), on, "inner", many)
    return few.unionByName(wide)


def _largest(hot: HotKeys) -> HotKeys:
    """One entry per key, with the larger number of splits."""
    merged: dict = {}
    for key, splits in hot:
        merged[key] = max(splits, merged.get(key, 1))
    return list(merged.items())
