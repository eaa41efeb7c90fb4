"""Counts of events per interval, from a stream that is not in order.

An interval is sent on once the watermark, the latest time seen less the allowed delay, has
passed its end. Events that come after that are dropped; all others count, whatever order
they come in. State holds the counts of the intervals that are still open.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

EVENTS = "event_id bigint, ts timestamp, event_type string, value double"
COUNTS = "start timestamp, end timestamp, event_type string, events bigint, cents bigint"


def event_counts(events: DataFrame, every: str, delay: str) -> DataFrame:
    """``start``, ``end``, ``event_type``, ``events`` and ``cents``, the sum of their values, of
    a stream or table of ``EVENTS``. Events without a time are in no interval."""
    return (
        events.withWatermark("ts", delay)
        .groupBy(F.window("ts", every).alias("interval"), "event_type")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents"),
        )
        .select("interval.start", "interval.end", "event_type", "events", "cents")
    )


def follow_events(
    spark: SparkSession, folder: str, out: str, checkpoint: str, every: str, delay: str
) -> StreamingQuery:
    """Work off the events (Parquet) that are there and write the intervals that are over to
    ``out``; started again, it goes on from ``checkpoint``."""
    events = spark.readStream.schema(EVENTS).parquet(folder)
    writer = event_counts(events, every, delay).writeStream.format("parquet")
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
