"""Rules on a finished route: rewriting, chute, message."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from totelane.functions import fixed


def route_noncon(origroute: Column) -> Column:
    """4 when the route has a stop for goods that do not fit the conveyor, else 0."""
    special = origroute.contains(fixed.NONCON_ZONE) | origroute.contains(fixed.HOSPITAL_ZONE)
    return F.when(special, F.lit(fixed.NONCON_FLAG)).otherwise(F.lit(0))


def rewrite_route(origroute: Column) -> Column:
    """The route the conveyor can drive: hospital and packing need no stops."""
    ends = origroute.contains(fixed.HOSPITAL_ZONE) | origroute.contains(fixed.PACKING_ZONE)
    return F.when(ends, F.lit(fixed.NO_STOPS)).otherwise(
        F.replace(origroute, F.lit(fixed.NONCON_ZONE), F.lit(fixed.NO_STOPS))
    )


def route_chute(route: Column) -> Column:
    return F.when(route == fixed.NO_STOPS, F.lit(fixed.CHUTE_NONCON)).otherwise(
        F.lit(fixed.CHUTE_RECIRCULATE)
    )


def completion_chute(noncon: Column) -> Column:
    """Chute of a tote without open picks; an unknown flag counts as conveyable."""
    return F.when(noncon == fixed.NONCON_FLAG, F.lit(fixed.CHUTE_NONCON)).otherwise(
        F.lit(fixed.CHUTE_DONE)
    )


def message(tote_id: Column, path: Column, chute: Column) -> Column:
    """The conveyor's routing message as JSON text."""
    return F.to_json(F.struct(tote_id.alias("tote"), path.alias("path"), chute.alias("chute")))
