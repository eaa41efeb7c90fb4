"""One route per tote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from totelane.functions import fixed
from totelane.functions.locations import spread_zone
from totelane.functions.routes import rewrite_route, route_chute, route_noncon
from totelane.operators.destinations import item_zones
from totelane.operators.measures import Measures
from totelane.settings import RouterSettings
from totelane.sources.warehouse import Warehouse


def tote_zone_sets(
    warehouse: Warehouse, settings: RouterSettings, measures: Measures
) -> DataFrame:
    """Per open tote: ``tote_key``, ``tote_id`` as spelled, ``zones`` sorted and distinct.

    A tote keeps at most one entry per spelling of a zone, in the tasks that read its items
    as well as after the shuffle, so a tote with very many items stays small. Zones are in
    order of their names without regard to case, in which routes are compared; spellings that
    differ in case are one zone, for which the first of them by name stands.
    """
    items = item_zones(warehouse, settings.states, measures)
    own = F.array(spread_zone(F.col("tote_key"), settings.random_mode))
    listed = F.when(F.col("spread"), F.concat("zones", own)).otherwise(F.col("zones"))
    spelt = F.struct(F.upper("zone").alias("key"), "zone")
    return (
        items.select("tote_key", "tote_id", F.explode(listed).alias("zone"))
        .groupBy("tote_key")
        .agg(F.min("tote_id").alias("tote_id"), F.array_sort(F.collect_set(spelt)).alias("spelt"))
        .select("tote_key", "tote_id", one_spelling("spelt").alias("zones"))
    )


def one_spelling(spelt: str) -> Column:
    """The zones of a sorted array of ``key`` and ``zone``, the first one of each key."""
    before = F.transform(spelt, lambda entry: entry["key"])

    def first(entry: Column, place: Column) -> Column:
        return (place == 0) | (F.get(before, place - 1) != entry["key"])

    return F.transform(F.filter(spelt, first), lambda entry: entry["zone"])


def tote_zones(zone_sets: DataFrame) -> DataFrame:
    return zone_sets.select("tote_key", F.explode("zones").alias("zone"))


def tote_routes(zone_sets: DataFrame) -> DataFrame:
    """``origroute``: the zones of a tote in order. Ids of one character are no real totes."""
    return zone_sets.filter(F.length("tote_key") > 1).select(
        "tote_key", "tote_id", F.array_join("zones", fixed.DELIMITER).alias("origroute")
    )


def planned_routes(routes: DataFrame) -> DataFrame:
    """``route``, ``noncon`` and ``chute`` for each ``origroute``."""
    return (
        routes.withColumn("route", rewrite_route(F.col("origroute")))
        .withColumn("noncon", route_noncon(F.col("origroute")))
        .withColumn("chute", route_chute(F.col("route")))
    )


def spread_totes(
    warehouse: Warehouse, settings: RouterSettings, measures: Measures
) -> DataFrame:
    """Totes with goods at a RANDOM location and the zone they get in either mode."""
    items = item_zones(warehouse, settings.states, measures)
    tote = F.col("tote_key")
    return (
        items.filter("spread")
        .select("tote_key")
        .distinct()
        .select(
            "tote_key",
            spread_zone(tote).alias("zone"),
            spread_zone(tote, "legacy").alias("legacy_zone"),
        )
    )
