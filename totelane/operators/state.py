"""The table of stored routes: what expires, what is pending, what is done."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from totelane.functions import fixed
from totelane.functions.routes import completion_chute
from totelane.operators.skew import HotKeys, hot_keys, spread_join
from totelane.settings import SkewSettings


def moment(as_of: datetime) -> Column:
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def is_expired(as_of: datetime) -> Column:
    """Sent more than an hour ago. The column stands alone, so that it reaches the scan."""
    limit = moment(as_of) - F.make_dt_interval(hours=F.lit(fixed.ROUTE_TTL_HOURS))
    return F.col("routed_date") < limit


def expired_routes(state: DataFrame, as_of: datetime) -> DataFrame:
    return state.filter(is_expired(as_of))


def expired_totes(state: DataFrame, as_of: datetime) -> DataFrame:
    return expired_routes(state, as_of).select("tote_key").distinct()


@dataclass(frozen=True)
class StateMeasures:
    hot: HotKeys
    last_id: int


def measure_state(state: DataFrame, skew: SkewSettings) -> StateMeasures:
    """Totes with very many rows, and the highest id in use."""
    hot, found = hot_keys(state, ["tote_key"], skew, greatest="id")
    return StateMeasures(hot["tote_key"], found["_greatest"] or 0)


def without_totes(state: DataFrame, totes: DataFrame, hot: HotKeys) -> DataFrame:
    """``state`` less all rows of the given totes."""
    kept = spread_join(state, totes, "tote_key", "left_anti", hot)
    return kept.select(*state.columns)


def state_after_purge(state: DataFrame, as_of: datetime, hot: HotKeys) -> DataFrame:
    return without_totes(state, expired_totes(state, as_of), hot)


def pending_routes(state: DataFrame) -> DataFrame:
    return state.filter(F.col("routed_date").isNull())


def stored_routes(state: DataFrame, as_of: datetime) -> DataFrame:
    """One row per tote that outlives the purge: its newest row, as ``stored_*``.

    One expired row removes a tote with all its rows, so both are one aggregation.
    """
    row = F.struct("id", "tote_id", "route", "noncon")
    return (
        state.filter(F.col("tote_key").isNotNull())
        .groupBy("tote_key")
        .agg(
            F.max_by(row, "id").alias("newest"),
            F.bool_or(F.coalesce(is_expired(as_of), F.lit(False))).alias("expired"),
        )
        .filter(~F.col("expired"))
        .select(
            "tote_key",
            F.col("newest.id").alias("stored_id"),
            F.col("newest.tote_id").alias("stored_tote_id"),
            F.col("newest.route").alias("stored_route"),
            F.col("newest.noncon").alias("stored_noncon"),
        )
    )


def open_vs_state(tote_zones: DataFrame, stored: DataFrame, tote_state: Column) -> DataFrame:
    """Every open tote and zone beside the stored row, and stored totes without open picks."""
    joined = tote_zones.withColumn("tote_state", tote_state).join(stored, "tote_key", "full_outer")
    is_stored = F.col("stored_id").isNotNull()
    return joined.select(
        "tote_key",
        "tote_state",
        F.lit(fixed.CHUTE_RECIRCULATE).alias("chute"),
        F.coalesce("zone", F.lit(fixed.NONCON_ZONE)).alias("zone"),
        F.when(is_stored, F.col("tote_key")).alias("state_tote"),
        F.col("stored_noncon").alias("noncon"),
    )


def completed_totes(stored: DataFrame, open_totes: DataFrame) -> DataFrame:
    """Stored totes with nothing left to pick, and the chute they leave by."""
    done = stored.join(open_totes.select("tote_key"), "tote_key", "left_anti")
    return done.select(
        "tote_key",
        F.lit(fixed.NO_STOPS).alias("path"),
        completion_chute(F.col("stored_noncon")).alias("chute"),
    )


def lost_completions(expired: DataFrame, open_totes: DataFrame) -> DataFrame:
    """Totes purged in the gap in which they were finished: they get no last message."""
    return expired.filter(F.col("tote_key").isNotNull()).join(
        open_totes.select("tote_key"), "tote_key", "left_anti"
    )


def rejected_rows(tote_detail: DataFrame, state: DataFrame) -> DataFrame:
    """Rows that name no tote. They cannot be routed and must not stop the run."""

    def nameless(df: DataFrame, source: str, item: str) -> DataFrame:
        return df.filter(F.col("tote_key").isNull()).select(
            F.lit(source).alias("source"), F.col(item).cast("string").alias("item")
        )

    return nameless(tote_detail, "tote_detail", "inventory_key").unionByName(
        nameless(state, "tote_router", "id")
    )
