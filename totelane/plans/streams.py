"""Queries that go through a stream or a sink. For streams the supplied tables, cut into
arrivals, are put into a folder one after the other, and the stream is started again after each."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from totelane.operators.state import moment
from totelane.plans.run import RoutingRun, import_state, record_answers
from totelane.session import durable, shared_folder
from totelane.settings import RouterSettings
from totelane.sources import messages, testdata
from totelane.sources.parts import part_of
from totelane.sources.state_store import StateStore
from totelane.streaming import answers, events, increments, sessions

SETTINGS = RouterSettings(as_of=testdata.AS_OF)
#: Time that is later than all others and moves the watermark beyond them.
CLOSING = "2100-01-01 00:00:00"
PARTS = 256


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/totelane/{uuid.uuid4().hex}"


def _run(spark: SparkSession, sf_dir: str) -> RoutingRun:
    return RoutingRun(testdata.warehouse(spark, sf_dir), testdata.state(spark, sf_dir), SETTINGS)


def _work_off(start: Callable[[], StreamingQuery], arrivals: Iterable[tuple[str, DataFrame]]) -> None:
    """Put each arrival into its folder and let the stream work it off."""
    for folder, rows in arrivals:
        rows.write.mode("append").parquet(folder)
        start().awaitTermination()


def _draw(*columns: str) -> Column:
    """A number from the text of some columns, the same in every engine."""
    text = F.concat_ws("/", *columns)
    return F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("bigint")


def _closing(spark: SparkSession, schema: str, **values) -> DataFrame:
    """A row with nothing but what is given."""
    return spark.range(1).select(
        *(F.lit(values.get(name)).cast(kind).alias(name) for name, kind in _columns(schema))
    )


def _columns(schema: str) -> list[tuple[str, str]]:
    return [tuple(column.split()) for column in schema.split(", ")]


def event_counts(spark, sf_dir):
    """Events per six hours and kind. They arrive by the week, every seventh a day late, every
    31st twelve days late, where two days are allowed."""
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    late = F.when(F.col("event_id") % 31 == 0, 12).when(F.col("event_id") % 7 == 0, 1).otherwise(0)
    week = F.floor((F.unix_date(F.col("ts").cast("date")) + late) / 7)
    columns = [F.col(name).cast(kind).alias(name) for name, kind in _columns(events.EVENTS)]
    arrived = durable(raw.select(*columns, week.alias("week")))
    weeks = sorted(row["week"] for row in arrived.select("week").distinct().collect())
    folder = new_folder(spark)
    source = f"{folder}/events"

    def start() -> StreamingQuery:
        return events.follow_events(
            spark, source, f"{folder}/counts", f"{folder}/progress", "6 hours", "2 days"
        )

    parts = [(source, arrived.filter(F.col("week") == week).drop("week")) for week in weeks]
    _work_off(start, [*parts, (source, _closing(spark, events.EVENTS, ts=CLOSING))])
    counts = spark.read.schema(events.COUNTS).parquet(f"{folder}/counts")
    times = [F.col(name).cast("timestamp_ntz").alias(name) for name in ("start", "end")]
    return counts.select(*times, "event_type", "events", "cents")


def stateful_routes(spark, sf_dir):
    """Routes of an hour each from sightings over four hours, every fifth of which arrives two
    hours late."""
    zones = _run(spark, sf_dir).tote_zones
    minute = _draw("tote_key", "zone") % 240
    late = F.when(_draw("zone", "tote_key") % 5 == 0, 120).otherwise(0)
    seen = (moment(testdata.AS_OF) + F.make_dt_interval(mins=minute.cast("int"))).cast("timestamp")
    sightings = durable(
        zones.select(
            "tote_key", "zone", seen.alias("seen"), F.floor((minute + late) / 180).alias("arrival")
        )
    )
    folder = new_folder(spark)
    source = f"{folder}/sightings"

    def start() -> StreamingQuery:
        return sessions.follow_sightings(
            spark, source, f"{folder}/routes", f"{folder}/progress", "4 hours"
        )

    parts = [(source, sightings.filter(F.col("arrival") == n).drop("arrival")) for n in range(2)]
    closing = _closing(spark, sessions.SIGHTINGS, tote_key="", seen=CLOSING)
    _work_off(start, [*parts, (source, closing)])
    routes = spark.read.schema(sessions.SESSIONS).parquet(f"{folder}/routes")
    times = [F.col(name).cast("timestamp_ntz").alias(name) for name in ("opened", "expires")]
    return routes.select("tote_key", "origroute", *times)


def _changed(spark: SparkSession, sf_dir: str) -> increments.IncrementalPlanner:
    """A planner that got the lines in two batches. The first one has lines that the second
    one takes away again."""
    wh = testdata.warehouse(spark, sf_dir)
    raw = testdata.tables(spark, sf_dir)["trans_detail"]
    lines = raw.withColumn("change", F.lit(1))
    wrong = raw.filter(F.col("tran_id") % 5 == 0).withColumn("location_id", F.lit("HOSP-01"))
    first = lines.filter(F.col("tran_id") % 3 != 0).unionByName(wrong.withColumn("change", F.lit(1)))
    second = lines.filter(F.col("tran_id") % 3 == 0).unionByName(wrong.withColumn("change", F.lit(-1)))
    folder = new_folder(spark)
    source = f"{folder}/changes"
    planner = increments.IncrementalPlanner(wh, SETTINGS, f"{folder}/counts")

    def start() -> StreamingQuery:
        return increments.follow_changes(
            spark, source, planner, f"{folder}/routes", f"{folder}/progress"
        )

    _work_off(start, [(source, first), (source, second)])
    return planner


def incremental_routes(spark, sf_dir):
    """The planned routes after the lines came as changes."""
    return _changed(spark, sf_dir).routes()


def incremental_reconcile(spark, sf_dir):
    """The planned routes against the stored ones, without planning anew."""
    zones = _changed(spark, sf_dir).zone_sets()
    warehouse, state = testdata.warehouse(spark, sf_dir), testdata.state(spark, sf_dir)
    return RoutingRun(warehouse, state, SETTINGS, zone_sets=zones).reconciled


def _timed_answers(outbox: DataFrame) -> DataFrame:
    """The conveyor's answers with their times: some minutes after the message, for a quarter
    of them too many; each thirteenth is accepted five minutes later after all."""
    place = F.col("seq")
    minutes = (place % 40).cast("int")
    rows = outbox.filter(place % 11 != 0).withColumn(
        "status", F.when(place % 7 == 0, 500).otherwise(201)
    ).withColumn("minutes", minutes)
    again = rows.filter(place % 13 == 0).withColumn("status", F.lit(201)).withColumn(
        "minutes", F.col("minutes") + 5
    )
    told = F.col("sent_at") + F.make_dt_interval(mins=F.col("minutes"))
    return rows.unionByName(again).select(
        "id", "tote_id", F.col("status").cast("int").alias("status"), told.alias("answered_at"), "seq"
    )


def _answer_stream(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, StateStore]:
    """What came of each message, and the store with the marks: half an hour is allowed."""
    folder = new_folder(spark)
    run = _run(spark, sf_dir)
    sent_at = moment(testdata.AS_OF) + F.make_dt_interval(secs=F.col("seq") % 3600)
    outbox = run.outbox.select(
        "seq", "kind", "id", "tote_id", sent_at.cast("timestamp").alias("sent_at")
    )
    told = _timed_answers(outbox)
    store = StateStore(spark, f"{folder}/store")
    import_state(store, durable(run.next_state), SETTINGS)
    sent, heard = f"{folder}/messages", f"{folder}/answers"

    def start() -> StreamingQuery:
        return answers.follow_answers(
            spark, sent, heard, store.root, f"{folder}/outcomes", f"{folder}/progress",
            SETTINGS, "30 MINUTES", "4 hours",
        )

    late = F.col("seq") % 3 == 0
    # Some answers come after their messages, others before them.
    outbox.filter(~late).write.parquet(sent)
    told.drop("seq").filter(F.lit(False)).write.parquet(heard)
    _work_off(start, [(heard, told.drop("seq")), (sent, outbox.filter(late))])
    _closing(spark, answers.ANSWERS, tote_id="", answered_at=CLOSING).write.mode("append").parquet(heard)
    _work_off(start, [(sent, _closing(spark, answers.MESSAGES, sent_at=CLOSING))])
    found = spark.read.schema(answers.OUTCOMES).parquet(f"{folder}/outcomes")
    return found, store


def streamed_answers(spark, sf_dir):
    """What came of each message, from two streams."""
    found, _ = _answer_stream(spark, sf_dir)
    return answers.outcomes(found).select("seq", "kind", "id", "tote_id", "event")


def answered_state(spark, sf_dir):
    """The state after the answers in time were marked as they came."""
    _, store = _answer_stream(spark, sf_dir)
    return store.latest().state.select("id", "tote_id", "route", "chute", "noncon", "routed_date")


def answered_parts(spark, sf_dir):
    """The parts of the state, and whether answers for one in 101 pending routes wrote them."""
    store = StateStore(spark, f"{new_folder(spark)}/store", PARTS)
    import_state(store, testdata.state(spark, sf_dir), SETTINGS)
    before = store.latest()
    named = before.state.filter("routed_date IS NULL AND tote_key IS NOT NULL AND id % 101 = 0")
    acks = named.select("id", "tote_id", F.lit(201).alias("status"))
    record_answers(store, durable(acks), SETTINGS, "answers")
    after = store.latest()
    written = [(n, after.folders[n] != before.folders.get(n)) for n in sorted(after.folders)]
    rows = after.state.groupBy(part_of("tote_key", PARTS).alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.count("routed_date").alias("routed")
    )
    return rows.join(spark.createDataFrame(written, "part int, written boolean"), "part")


def sent_messages(spark, sf_dir):
    """The messages of a run as the conveyor finds them; the run sends them twice."""
    path, outbox = new_folder(spark), _run(spark, sf_dir).outbox
    for _ in range(2):
        messages.send(outbox, path, "run")
    return spark.read.format(messages.FORMAT).load(path)


QUERIES = {
    "sent_messages": sent_messages,
    "event_counts": event_counts,
    "stateful_routes": stateful_routes,
    "incremental_routes": incremental_routes,
    "incremental_reconcile": incremental_reconcile,
    "streamed_answers": streamed_answers,
    "answered_state": answered_state,
    "answered_parts": answered_parts,
}
