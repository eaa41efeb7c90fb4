"""Routes kept as state inside a stream: one hour from the first sighting of a tote.

A sighting says that a tote still has something to pick in a zone. The first one opens a
route; sightings up to and including an hour later add stops to it, and what was seen later
opens the next one. The result depends on the times of the sightings alone, not on how they
are cut into batches, as long as none comes later than the watermark allows; those are dropped.

An hour without sightings always ends a route, so the sightings between two such hours can be
cut into routes by themselves. Spark's session windows gather them, one row of state per tote;
when the watermark has passed the hour after the last of them, they are cut and sent on, and
the state forgets them. A tote seen again and again is sent on when it has not been seen for
an hour. Sightings without a tote or time are left out, those without a zone count as no stop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from totelane.functions import fixed
from totelane.operators.routes import one_spelling

SIGHTINGS = "tote_key string, zone string, seen timestamp"
SESSIONS = "tote_key string, origroute string, opened timestamp, expires timestamp"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_HOUR = fixed.ROUTE_TTL_HOURS * 3_600_000_000
#: Longer than a route, so that a sighting at its very end belongs to the same gathering.
_GAP = f"{fixed.ROUTE_TTL_HOURS} hours 1 millisecond"


def _openings(sightings: Column) -> Column:
    """The moments, among those of sorted sightings, at which a route opens."""

    def opened(found: Column, sighting: Column) -> Column:
        moment = sighting["moment"]
        still_open = moment <= F.element_at(found, -1) + F.lit(_HOUR)
        return F.when((F.size(found) > 0) & still_open, found).otherwise(
            F.concat(found, F.array(moment))
        )

    return F.aggregate(sightings, F.array().cast("array<bigint>"), opened)


def _stops(sightings: Column, opened: Column) -> Column:
    """The zones of a route by name without regard to case, the first spelling of each."""
    inside = F.filter(
        sightings,
        lambda one: one["moment"].between(opened, opened + F.lit(_HOUR)) & one["zone"].isNotNull(),
    )
    spelt = F.transform(
        inside, lambda one: F.struct(F.upper(one["zone"]).alias("key"), one["zone"].alias("zone"))
    )
    return F.array_sort(F.array_distinct(spelt))


def route_sessions(sightings: DataFrame, delay: str) -> DataFrame:
    """``tote_key``, ``origroute``, ``opened``, ``expires`` of each route of a stream of
    ``SIGHTINGS`` that are at most ``delay`` late, once its tote was not seen for an hour."""
    named = sightings.filter(F.col("tote_key").isNotNull() & F.col("seen").isNotNull())
    # Copies are dropped, and with them sightings that are too late.
    once = named.withWatermark("seen", delay).dropDuplicates(["tote_key", "zone", "seen"])
    sighting = F.struct(F.unix_micros("seen").alias("moment"), "zone")
    gathered = once.groupBy("tote_key", F.session_window("seen", _GAP)).agg(
        F.array_sort(F.collect_list(sighting)).alias("sightings")
    )
    opened = F.col("opened")
    cut = gathered.select("tote_key", "sightings", F.explode(_openings(F.col("sightings"))).alias("opened"))
    spelt = cut.select("tote_key", "opened", _stops(F.col("sightings"), opened).alias("spelt"))
    return spelt.select(
        "tote_key",
        F.array_join(one_spelling("spelt"), fixed.DELIMITER).alias("origroute"),
        F.timestamp_micros(opened).alias("opened"),
        F.timestamp_micros(opened + F.lit(_HOUR)).alias("expires"),
    )


def follow_sightings(
    spark: SparkSession, sightings_folder: str, out: str, checkpoint: str, delay: str
) -> StreamingQuery:
    """Work off the sightings (Parquet) that are there and write the routes that are over to
    ``out``; started again, it goes on from ``checkpoint``."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKS)
    try:
        sightings = spark.readStream.schema(SIGHTINGS).parquet(sightings_folder)
        routes = route_sessions(sightings, delay)
        writer = routes.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        return writer.trigger(availableNow=True).start(out)
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)
