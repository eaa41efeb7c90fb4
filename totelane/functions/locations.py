"""Rules that turn a location into the next one or into a zone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from totelane.functions import fixed


def pick_location(location_key: Column) -> Column:
    """Where a pick really sends the tote; the first rule that matches wins."""
    area, code = F.substring(location_key, 1, 2), F.substring(location_key, 1, 3)
    return (
        F.when(area.isin(*fixed.NONCON_AREAS), F.lit(fixed.NONCON_ZONE))
        .when(code.between(*fixed.KEPT_FLOOR), location_key)
        .when(area.between(*fixed.NONCON_AISLES), F.lit(fixed.NONCON_ZONE))
        .otherwise(location_key)
    )


def order_destination(status_key: Column) -> Column:
    """Destination given by the order's status; none while the status is unknown."""
    return F.when(status_key == fixed.PICKED_STATUS, F.lit(fixed.PACKING_LOCATION)).when(
        status_key.isNotNull(), F.lit(fixed.NONCON_ZONE)
    )


def zone_by_rule(location_key: Column) -> Column:
    """Zone of packing and of the first floor, which no table lists; else NULL."""
    code = F.substring(location_key, 1, 3)
    packing = F.when(location_key == fixed.PACKING_LOCATION, F.lit(fixed.PACKING_ZONE))
    return reduce(
        lambda rule, row: rule.when(code.between(row[0], row[1]), F.lit(row[2])),
        fixed.FLOOR_ZONES,
        packing,
    )


def spread_zone(tote_key: Column, mode: str = "spread") -> Column:
    """The zone a tote gets for a RANDOM location: always the same one for the same tote."""
    zones = fixed.SPREAD_ZONES if mode == "spread" else fixed.LEGACY_SPREAD
    draw = F.conv(F.substring(F.md5(tote_key), 1, 6), 16, 10).cast("bigint")
    bucket = F.pmod(draw, F.lit(len(zones))).cast("int") + 1
    return F.element_at(F.array(*[F.lit(zone) for zone in zones]), bucket)
