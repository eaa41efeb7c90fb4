"""Messages to the conveyor and what its answers change."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from totelane.functions import fixed
from totelane.functions.routes import message
from totelane.functions.text import key
from totelane.operators.numbering import number_rows
from totelane.operators.reconcile import COMPLETE
from totelane.operators.state import moment


def dispatch_outbox(
    reconciled: DataFrame, pending: DataFrame, path: str | None = None
) -> DataFrame:
    """All messages of a run in sending order: finished totes, then ``pending`` routes of the
    next state by id.

    A pending row without a route has nothing to say, and one without a tote nobody to say it
    to; both stay in the state.
    """
    finished = reconciled.filter(F.col("action") == COMPLETE).select(
        F.lit("COMPLETION").alias("kind"),
        F.lit(None).cast("bigint").alias("id"),
        "tote_key",
        "tote_id",
        F.col("route").alias("path"),
        "chute",
    )
    named = pending.filter(F.col("route").isNotNull() & F.col("tote_key").isNotNull())
    waiting = named.select(
        F.lit("ROUTE").alias("kind"),
        "id",
        "tote_key",
        "tote_id",
        F.col("route").alias("path"),
        F.coalesce("chute", F.lit(0)).alias("chute"),
    )
    outbox = finished.unionByName(waiting).withColumn(
        "payload", message(F.col("tote_id"), F.col("path"), F.col("chute"))
    )
    order = [F.col("id").asc_nulls_first(), F.col("tote_key").asc()]
    return number_rows(outbox, order, "seq", path)


def no_answers(outbox: DataFrame) -> DataFrame:
    """For a conveyor that answers later: nothing is accepted yet, see ``plans.run.record_answers``."""
    return outbox.select("id", "tote_id", F.lit(0).alias("status")).filter(F.lit(False))


def accepted(acks: DataFrame) -> DataFrame:
    """Answers that count as success."""
    return acks.filter(F.col("status") == fixed.ACCEPTED).select("id", "tote_id")


def accepted_totes(acks: DataFrame) -> DataFrame:
    """``tote_key`` of accepted routes; last messages have no id and change no row."""
    return accepted(acks).filter(F.col("id").isNotNull()).select(key("tote_id").alias("tote_key"))


def answered(outbox: DataFrame, acks: DataFrame) -> DataFrame:
    """The outbox with ``accepted``: whether the conveyor accepted this id for this tote, NULL
    if it has not answered. Of several answers one acceptance is enough. Answers to last
    messages, which have no id, are matched by tote."""
    heard = acks.groupBy(F.col("id").alias("_id"), key("tote_id").alias("_tote")).agg(
        F.max(F.coalesce(F.col("status") == fixed.ACCEPTED, F.lit(False))).alias("accepted")
    )
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("tote_key") == F.col("_tote"))
    return outbox.join(heard, same, "left").drop("_id", "_tote")


def failed_dispatches(outbox: DataFrame, acks: DataFrame) -> DataFrame:
    """Routes sent without success, for whatever reason; the next run sends them again."""
    silent = ~F.coalesce("accepted", F.lit(False))
    sent = answered(outbox, acks).filter(F.col("id").isNotNull() & silent)
    return sent.select("id", "tote_id", "path", "chute")


def outbox_events(outbox: DataFrame, acks: DataFrame) -> DataFrame:
    """One row per event of a message: that a route was sent, and what came of each message.
    A last message without success is not sent again: its tote leaves the state anyway."""
    sent = outbox.filter(F.col("id").isNotNull()).select(F.lit("DISPATCHED").alias("event"))
    return sent.unionByName(answer_events(outbox, acks))


def answer_events(outbox: DataFrame, acks: DataFrame) -> DataFrame:
    """What came of each message; an accepted last message is no event."""
    event = answer_event(F.col("id"), F.col("accepted"))
    return answered(outbox, acks).select(event.alias("event")).filter("event IS NOT NULL")


def answer_event(id: Column, accepted: Column) -> Column:
    """What came of a message, by whether it was accepted; null where it was not answered."""
    of_last = F.when(accepted.isNull(), "COMPLETION_UNANSWERED").when(~accepted, "COMPLETION_FAILED")
    of_route = F.when(accepted.isNull(), "UNANSWERED").when(accepted, "ROUTED").otherwise("FAILED")
    return F.when(id.isNull(), of_last).otherwise(of_route)


def mark_routed(state: DataFrame, acks: DataFrame, as_of: datetime) -> DataFrame:
    """``state`` with the time of sending on accepted pending rows, matched by id and tote. A
    repeated answer does not renew a route."""
    done = (
        accepted(acks)
        .select("id", key("tote_id").alias("tote_key"))
        .distinct()
        .withColumn("_sent", F.lit(True))
    )
    joined = state.join(done, ["id", "tote_key"], "left")
    sent = F.when(F.col("_sent"), moment(as_of))
    return joined.withColumn("routed_date", F.coalesce("routed_date", sent)).select(*state.columns)
