"""Planned routes against stored ones, and the state that follows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from totelane.functions import fixed
from totelane.functions.routes import completion_chute
from totelane.functions.text import clean, same_text
from totelane.operators.routes import planned_routes

KEEP = "KEEP"
INSERT = "INSERT"
INSERT_ON_BLANK = "INSERT_ON_BLANK"
REPLACE = "REPLACE"
COMPLETE = "COMPLETE"

ACTIONS = (KEEP, INSERT, INSERT_ON_BLANK, REPLACE, COMPLETE)
NEW_ROW_ACTIONS = (INSERT, INSERT_ON_BLANK, REPLACE)
REMOVING_ACTIONS = (REPLACE, COMPLETE)


def route_reconcile(zone_sets: DataFrame, stored: DataFrame) -> DataFrame:
    """One row per tote that is open or stored, with the ``action`` it calls for.

    Both sides have one row per tote and arrive partitioned by it. Chute and flag take no
    part in the comparison. A stored row with a blank route is added to, not replaced.
    """
    routed = planned_routes(
        zone_sets.withColumn("origroute", F.array_join("zones", fixed.DELIMITER)).drop("zones")
    )
    joined = routed.join(stored, "tote_key", "full_outer")
    is_open, is_stored = F.col("origroute").isNotNull(), F.col("stored_id").isNotNull()
    old = F.coalesce("stored_route", F.lit(""))
    action = (
        F.when(~is_open, COMPLETE)
        .when(same_text(old, F.col("route")), KEEP)
        .when(~is_stored, INSERT)
        .when(old == "", INSERT_ON_BLANK)
        .otherwise(REPLACE)
    )
    return joined.filter(~is_open | (F.length("tote_key") > 1)).select(
        "tote_key",
        F.when(is_open, F.col("tote_id")).otherwise(clean("stored_tote_id")).alias("tote_id"),
        action.alias("action"),
        "origroute",
        F.when(is_open, F.col("route")).otherwise(fixed.NO_STOPS).alias("route"),
        F.when(is_open, F.col("chute"))
        .otherwise(completion_chute(F.col("stored_noncon")))
        .alias("chute"),
        F.when(is_open, F.col("noncon"))
        .otherwise(F.coalesce("stored_noncon", F.lit(0)))
        .alias("noncon"),
        "stored_route",
    )


def new_rows(reconciled: DataFrame) -> DataFrame:
    return reconciled.filter(F.col("action").isin(*NEW_ROW_ACTIONS)).select(
        "tote_id",
        "route",
        "chute",
        "noncon",
        F.lit(None).cast("timestamp_ntz").alias("routed_date"),
        "tote_key",
    )


def state_inserts(placed: DataFrame, last_id: int) -> DataFrame:
    """New state rows; ids go on from ``last_id`` without a gap."""
    return placed.select((F.col("position") + F.lit(last_id)).alias("id"), *placed.columns).drop(
        "position"
    )


def removed_totes(reconciled: DataFrame, expired: DataFrame) -> DataFrame:
    """Totes whose rows leave the state. A tote that expired is stored no more, so the two
    parts overlap at most in re-planned totes, which an anti join does not mind."""
    gone = reconciled.filter(F.col("action").isin(*REMOVING_ACTIONS)).select("tote_key")
    return gone.unionByName(expired.filter(F.col("tote_key").isNotNull()))
