"""From locations to zones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from totelane.functions import fixed
from totelane.functions.locations import zone_by_rule
from totelane.operators.skew import Lookup
from totelane.session import durable
from totelane.settings import SkewSettings
from totelane.sources.warehouse import Warehouse


def location_zone_map(warehouse: Warehouse, skew: SkewSettings) -> DataFrame:
    """``location_key``, ``zone``: the last zone, by name, with picking at each location, as
    the list of locations spells it."""
    picking = warehouse.zone.filter(F.col("picking") == 1).select("zone_key").distinct()
    return (
        Lookup(picking, "zone_key", skew)
        .add_to(warehouse.zone_locations, "left_semi")
        .groupBy("location_key")
        .agg(F.max(F.struct("zone_key", "zone")).alias("last"))
        .select("location_key", F.col("last.zone").alias("zone"))
    )


class ZoneLookup:
    """Adds the zone of each row's ``location_key``. The map is written once: it is measured,
    joined, and asked for single locations."""

    def __init__(self, warehouse: Warehouse, skew: SkewSettings):
        table = location_zone_map(warehouse, skew).filter(F.col("location_key").isNotNull())
        self._table = table = durable(table)
        self._lookup = Lookup(
            table.withColumnRenamed("zone", "listed_zone"), "location_key", skew
        )

    def add_to(self, rows: DataFrame) -> DataFrame:
        """``zone``, and ``spread``: true for a RANDOM location, whose zone depends on the
        tote and is left NULL here. Without a location both are unset."""
        location = F.col("location_key")
        spread = location == fixed.RANDOM_LOCATION
        zone = F.when(~spread, F.coalesce(
            zone_by_rule(location), F.col("listed_zone"), F.lit(fixed.NONCON_ZONE)
        ))
        return (
            self._lookup.add_to(rows)
            .withColumn("zone", zone)
            .withColumn("spread", F.coalesce(spread, F.lit(False)))
            .drop("listed_zone")
        )

    def of_location(self, location_key: str) -> str:
        """The zone of one location; at most one row comes back."""
        found = self._table.filter(F.col("location_key") == location_key).first()
        return found["zone"] if found else fixed.NONCON_ZONE
