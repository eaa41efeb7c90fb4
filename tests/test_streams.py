"""Streams with state: events, routes of an hour, changed lines, answers."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import AS_OF, as_set
from totelane.plans.run import RoutingRun, import_state
from totelane.settings import SINGLE, RouterSettings
from totelane.sources.state_store import StateStore
from totelane.streaming import answers, events, increments, sessions

SETTINGS = RouterSettings(AS_OF)
DAY = datetime(2024, 1, 1)
END = datetime(2100, 1, 1)


def at(hours, minutes=0, seconds=0):
    return DAY + timedelta(hours=hours, minutes=minutes, seconds=seconds)


def put(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def work_off(query):
    assert query.awaitTermination(120) and query.exception() is None


@pytest.fixture
def counted(spark, folder):
    """Puts lists of events one after the other and returns the intervals that are over."""

    def run(*batches, close=True):
        source, out, progress = folder("events"), folder("counts"), folder("progress")
        for batch in [*batches, *([[(0, END, None, None)]] if close else [])]:
            put(spark, source, batch, events.EVENTS)
            work_off(events.follow_events(spark, source, out, progress, "1 hour", "2 hours"))
        return as_set(spark.read.schema(events.COUNTS).parquet(out))

    return run


def test_events_count_in_whatever_order_they_come_unless_too_late(counted):
    first = [(1, at(0, 10), "pick", 1.5), (2, at(4), "pick", 1.0), (3, None, "pick", 9.0)]
    # The watermark is at two o'clock: an interval that ended then is over.
    second = [(4, at(1, 59), "pick", 1.0), (5, at(2), "pick", 0.25), (6, at(0, 20), "pick", 1.0)]
    got = counted(first, second)
    assert got == {
        (at(0), at(1), "pick", 1, 150),
        (at(2), at(3), "pick", 1, 25),
        (at(4), at(5), "pick", 1, 100),
    }
    assert counted([*second, *first]) == {
        (at(0), at(1), "pick", 2, 250),
        (at(1), at(2), "pick", 1, 100),
        (at(2), at(3), "pick", 1, 25),
        (at(4), at(5), "pick", 1, 100),
    }


def test_intervals_stay_open_until_the_watermark_has_passed(counted):
    batch = [(1, at(0, 10), "pick", 1.0), (2, at(2, 59), "drop", 1.0)]
    assert counted(batch, close=False) == set()
    batch = [(1, at(0, 10), "pick", 1.0), (2, at(3), "drop", 1.0)]
    assert counted(batch, close=False) == {(at(0), at(1), "pick", 1, 100)}


@pytest.fixture
def routed(spark, folder):
    def run(*batches):
        source, out, progress = folder("sightings"), folder("routes"), folder("progress")
        for batch in [*batches, [("", None, END)]]:
            put(spark, source, batch, sessions.SIGHTINGS)
            work_off(sessions.follow_sightings(spark, source, out, progress, "3 hours"))
        return as_set(spark.read.schema(sessions.SESSIONS).parquet(out))

    return run


def test_routes_last_an_hour_and_do_not_depend_on_batches(routed):
    seen = [
        ("A", "FB", at(1)), ("A", "cc", at(1, 30)), ("A", "DD", at(2)), ("A", "HB", at(2, 0, 1)),
        ("A", "CC", at(1, 40)), ("A", "FB", at(1, 59)), ("A", "FB", at(1)), ("B", None, at(1)),
        (None, "X", at(1)), ("C", "X", None), ("A", "AA", at(0, 30)), ("D", "FB", at(2, 59, 59)),
    ]
    want = {
        ("A", "AA-cc-FB", at(0, 30), at(1, 30)),
        ("A", "CC-DD-FB-HB", at(1, 40), at(2, 40)),
        ("B", "", at(1), at(2)),
        ("D", "FB", at(2, 59, 59), at(3, 59, 59)),
    }
    assert routed(seen) == want
    random.Random(1).shuffle(seen)
    assert routed(seen[:4], seen[4:8], seen[8:]) == want


def test_a_sighting_at_the_very_end_of_a_route_is_a_stop(routed):
    micro = timedelta(microseconds=1)
    seen = [("A", "FB", at(1)), ("A", "CC", at(2)), ("B", "FB", at(1)), ("B", "CC", at(2) + micro)]
    assert routed(seen[:1], seen[1:], seen) == {
        ("A", "CC-FB", at(1), at(2)),
        ("B", "FB", at(1), at(2)),
        ("B", "CC", at(2) + micro, at(3) + micro),
    }


def test_sightings_that_are_too_late_count_no_more(routed):
    # The watermark is at three o'clock. What is later than that is dropped, by little or much.
    assert routed([("A", "FB", at(6))], [("A", "CC", at(2, 30)), ("A", "HB", at(4))]) == {
        ("A", "HB", at(4), at(5)),
        ("A", "FB", at(6), at(7)),
    }


def test_sightings_become_routes_without_python_in_the_stream(spark, folder):
    source = folder("sightings")
    put(spark, source, [("A", "FB", at(1))], sessions.SIGHTINGS)
    sightings = spark.readStream.schema(sessions.SIGHTINGS).parquet(source)
    plan = sessions.route_sessions(sightings, "3 hours")._jdf.queryExecution().analyzed().toString()
    assert "SessionWindow" in plan or "session_window" in plan
    assert "TransformWithState" not in plan and "Python" not in plan


@pytest.fixture
def lines(warehouse):
    def make(details):
        return warehouse(
            tote_detail=[("T1", "O1"), ("t1 ", "O2"), ("T2", "O2"), ("T3", "O3"), ("T3", "O3"), ("T", "O1")],
            trans=[(1, "pick", None, None, None), (1, "PICK", None, None, None), (2, "repl", None, None, None)],
            trans_detail=details,
            zone=[("CC", 1)],
            zone_locations=[("M1", "cc")],
        )

    return make


START = [
    (1, "O1", "1UA-1"), (1, "O1", "1UA-1"), (1, "O2", "1VG-1"), (1, "O3", "M1"), (2, "O3", "1VG-1"),
    (1, "O3", "RANDOM"), (1, "O2", None), (1, "", "1UA-1"), (1, "O9", "1UA-1"),
]


def planned(lines, details):
    routes = RoutingRun(lines(details), None, SETTINGS).preroutes
    return as_set(routes.select(*increments._ROUTES))


def test_increments_equal_one_batch_and_touch_their_totes_only(spark, lines, folder):
    planner = increments.IncrementalPlanner(lines([]), SETTINGS, folder("counts"), parts=64)
    out = folder("routes")
    details = list(START)

    def add(batch, changes):
        frame = spark.createDataFrame(changes, increments.CHANGES)
        before = planner.counts.newest()["folders"]
        changed = planner.add(frame, batch, out)
        after = planner.counts.newest()["folders"]
        assert {n for n in {*before, *after} if before.get(n) != after.get(n)} == set(changed)
        for *line, change in changes:
            details.append(tuple(line)) if change > 0 else details.remove(tuple(line))
        assert as_set(planner.routes()) == planned(lines, details)
        moved = spark.read.parquet(f"{out}/batch={batch}").collect() if changed else []
        return {row["tote_key"]: row["route"] for row in moved}

    details.clear()
    assert set(add(0, [(*x, 1) for x in START])) == {"T1", "T2", "T3"}
    # One of two equal lines is left, so the route stays.
    assert add(1, [(1, "O1", "1UA-1", -1)]) == {}
    assert add(2, [(1, "O1", "1UA-1", -1)]) == {"T1": "HB"}
    assert add(3, [(1, "O2", "1VG-1", -1), (1, "O3", "Packing", 1)]) == {"T1": None, "T2": None, "T3": "-"}
    assert add(4, [(2, "O3", "1UA-1", 1), (1, "O9", "1UA-1", -1)]) == {}
    # A batch that is repeated is not added again.
    assert planner.add(spark.createDataFrame([(1, "O1", "1UA-1", 1)], increments.CHANGES), 4, out) == []
    with pytest.raises(ValueError, match="taken away"):
        planner.add(spark.createDataFrame([(1, "O1", "1UA-1", -1)], increments.CHANGES), 9, out)


def test_items_and_picks_are_worked_out_once_for_all_batches(spark, lines, folder):
    worked_out = spark.sparkContext.accumulator(0)

    def counted(name):
        worked_out.add(1)
        return name

    wh = lines([])
    count = F.udf(counted).asNondeterministic()
    wh = replace(
        wh,
        tote_detail=wh.tote_detail.coalesce(1).withColumn("tote_id", count("tote_id")),
        trans=wh.trans.coalesce(1).withColumn("tran_type", count("tran_type")),
    )
    planner = increments.IncrementalPlanner(wh, SETTINGS, folder("counts"))
    made = worked_out.value
    assert made > 0
    for batch in range(2):
        planner.add(spark.createDataFrame([(*x, 1) for x in START], increments.CHANGES), batch, folder("routes"))
    assert worked_out.value == made
    want = planned(lines, START)
    assert as_set(planner.routes()) == want


def test_changes_follow_a_folder_and_go_on_after_a_stop(spark, lines, folder):
    source, out, progress, root = (folder(x) for x in ("changes", "routes", "progress", "counts"))
    for part in (START[:3], START[3:]):
        put(spark, source, [(*x, 1) for x in part], increments.CHANGES)
        planner = increments.IncrementalPlanner(lines([]), SETTINGS, root)
        work_off(increments.follow_changes(spark, source, planner, out, progress))
    assert as_set(planner.routes()) == planned(lines, START)
    assert planner.counts.newest()["batch"] == 1


def test_a_run_on_kept_zones_does_not_read_the_large_tables(spark, lines, stored, folder, monkeypatch):
    wh = lines(START)
    planner = increments.IncrementalPlanner(wh, SETTINGS, folder("counts"))
    planner.add(spark.createDataFrame([(*x, 1) for x in START], increments.CHANGES), 0, folder("routes"))
    old = stored((1, "T1", "FB-HB", 3, 0, AS_OF), (2, "T2", "JB", 3, 0, AS_OF), (3, "T8", "HB", 3, 0, AS_OF))
    want = as_set(RoutingRun(wh, old, SETTINGS).next_state)

    def unread(*_):
        raise AssertionError("planned anew")

    monkeypatch.setattr("totelane.plans.run.measure", unread)
    monkeypatch.setattr("totelane.operators.routes.tote_zone_sets", unread)
    run = RoutingRun(wh, old, SETTINGS, zone_sets=planner.zone_sets())
    assert as_set(run.next_state) == want


def test_increments_are_for_open_picks(lines, folder):
    with pytest.raises(ValueError):
        increments.IncrementalPlanner(
            lines([]), RouterSettings(AS_OF, states=(SINGLE, "PUTAWAY")), folder("counts")
        )


def test_answers_meet_their_messages_and_mark_routes_as_they_come(spark, stored, folder):
    root, out, progress = folder("store"), folder("outcomes"), folder("progress")
    messages, heard = folder("messages"), folder("answers")
    store = StateStore(spark, root)
    import_state(store, stored(*((n, f"T{n}", "FB", 3, 0, None) for n in range(1, 7))), SETTINGS)

    def follow():
        work_off(answers.follow_answers(
            spark, messages, heard, root, out, progress, SETTINGS, "30 MINUTES", "2 hours"
        ))

    def marked():
        return {row["id"] for row in store.latest().state.filter("routed_date IS NOT NULL").collect()}

    sent = [(n, "ROUTE", n, f"T{n}", at(1)) for n in range(1, 7)]
    sent += [(7, "COMPLETION", None, "T8", at(1)), (8, "COMPLETION", None, "T9", at(1))]
    put(spark, messages, sent, answers.MESSAGES)
    put(spark, heard, [
        (1, "t1 ", 201, at(1, 30)),  # just in time, spelt otherwise
        (2, "T2", 201, at(1, 30, 1)),  # too late
        (3, "T3", 500, at(1, 5)), (3, "T3", 201, at(1, 6)),  # accepted after all
        (4, "T4", 500, at(1, 5)),
        (5, "T9", 201, at(1, 5)),  # of another tote
        (6, "T6", 201, at(0, 59)),  # before the message
        (None, "T8", 201, at(1, 1)),
        (None, None, 201, at(1, 1)),
    ], answers.ANSWERS)
    follow()
    assert marked() == {1, 3}
    version = store.latest().version
    put(spark, heard, [(1, "T1", 201, at(1, 31)), (4, "T4", 201, at(1, 29))], answers.ANSWERS)
    follow()
    assert marked() == {1, 3, 4} and store.latest().version == version + 1

    def written():
        return spark.read.schema(answers.OUTCOMES).parquet(out)

    assert written().filter("status IS NULL").isEmpty()  # nothing is unanswered before its time is over
    put(spark, heard, [(None, "", None, END)], answers.ANSWERS)
    put(spark, messages, [(None, None, None, None, END)], answers.MESSAGES)
    follow()
    events_of = {row["seq"]: row["event"] for row in answers.outcomes(written()).collect()}
    assert events_of == {
        1: "ROUTED", 2: "UNANSWERED", 3: "ROUTED", 4: "ROUTED", 5: "UNANSWERED", 6: "UNANSWERED",
        7: None, 8: "COMPLETION_UNANSWERED",
    }
    assert store.latest().state.agg(F.max("routed_date")).first()[0] == AS_OF


def _random_conversation(draw):
    """Messages and answers of some hours with copies, gaps, odd totes and late rows."""

    def minute(hour, spread):
        return None if draw.random() < 0.05 else at(hour, draw.randint(-spread, 60))

    def tote():
        return draw.choice([None, "", " ", "T1", " t1", "T2", "t2 ", "T3"])

    ids = [None, 1, 2, 3]
    for hour in (2, 4, 6):
        sent = [(draw.randint(1, 99), "ROUTE", draw.choice(ids), tote(), minute(hour, 90)) for _ in range(25)]
        told = [
            (one[2], one[3], draw.choice([201, 500, None]), one[4] and one[4] + timedelta(minutes=draw.randint(-1, 32)))
            for one in draw.sample(sent, 20)
        ]
        yield [*sent, *sent[:2]], [*told, *told[:2], (draw.choice(ids), tote(), 201, minute(hour, 90))]
    yield [(None, None, None, None, END)], [(None, "", None, END)]


def _met_by_hand(batches, limit, delay):
    """Every message in time with its answers in time, or with none, pair by pair."""
    sent, told, watermark = [], [], datetime(1970, 1, 1)
    for new in batches:
        sent += [x for x in new[0] if x[4] is not None and x[4] > watermark]
        told += [x for x in new[1] if x[1] is not None and x[3] is not None and x[3] > watermark]
        latest = min(max(row[-1] for row in rows) for rows in (sent, told))
        watermark = max(watermark, latest - delay)

    def of(row, tote):
        name = "" if row is None else str(row)
        return name if tote is None else f"{name}/{tote.strip().upper()}"

    found = []
    for one in sent:
        met = [
            (x[2], x[3]) for x in told
            if of(x[0], x[1]) == of(one[2], one[3]) and one[4] <= x[3] <= one[4] + limit
        ]
        if met or one[4] < END:
            found += [(*one, *x) for x in met or [(None, None)]]
    return sorted(found, key=str)


@pytest.mark.parametrize("pieces", [1, 32])
def test_messages_and_answers_wait_in_files(spark, stored, folder, monkeypatch, pieces):
    monkeypatch.setattr(answers, "PIECES", pieces)
    root, out, progress = folder("store"), folder("outcomes"), folder("progress")
    messages, heard = folder("messages"), folder("answers")
    store = StateStore(spark, root)
    import_state(store, stored((1, "T1", "FB", 3, 0, None), (2, "T1", "FB", 3, 0, None)), SETTINGS)
    batches = list(_random_conversation(random.Random(7)))
    for sent, told in batches:
        put(spark, messages, sent, answers.MESSAGES)
        put(spark, heard, told, answers.ANSWERS)
        query = answers.follow_answers(
            spark, messages, heard, root, out, progress, SETTINGS, "30 MINUTES", "1 hour"
        )
        work_off(query)
        # Nothing waits in the memory of the executors.
        assert query.lastProgress["stateOperators"] == []
    got = [tuple(row)[:7] for row in spark.read.schema(answers.OUTCOMES).parquet(out).collect()]
    want = _met_by_hand(batches, timedelta(minutes=30), timedelta(hours=1))
    assert sorted(got, key=str) == want
    assert any(row[5] is None and row[6] is None for row in got) and any(row[5] for row in got)


def test_a_repeated_batch_of_answers_does_the_same_again(spark, folder):
    waiting = answers.Waiting(spark, folder("waiting"), "30 MINUTES", "1 hour")
    batches = list(_random_conversation(random.Random(8)))

    def add(n):
        sent, told = (
            spark.createDataFrame(rows, schema)
            for rows, schema in zip(batches[n], (answers.MESSAGES, answers.ANSWERS))
        )
        out = folder("outcomes")
        waiting.add(answers.arrivals(sent, told), n, out)
        rows = spark.read.schema(answers.OUTCOMES).parquet(out).collect()
        return sorted((tuple(row) for row in rows), key=str)

    for n in range(len(batches)):
        once = add(n)
        assert add(n) == once and (once or n == 0)
    with pytest.raises(ValueError, match="not known"):
        answers.Waiting(spark, folder("other"), "30 MINUTES", "1 hour").add(None, 1, folder("outcomes"))
