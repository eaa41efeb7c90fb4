"""Whole runs against the state store, in batch and as a stream."""

from __future__ import annotations

import json
import os
from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import AS_OF, as_set
from totelane import schemas
from totelane.__main__ import main
from totelane.operators.state import expired_routes
from totelane.plans.run import (
    RoutingRun,
    import_state,
    no_answers,
    record_answers,
    run_once,
)
from totelane.operators import measures, skew
from totelane.operators.measures import take_in, taken_in
from totelane.settings import RouterSettings, SkewSettings
from totelane.sources import testdata
from totelane.sources.state_store import StaleSnapshotError, StateStore
from totelane.sources.warehouse import Warehouse
from totelane.streaming.router import start_router

SF = "/root/testdata/sf0.001"
SETTINGS = RouterSettings(AS_OF)
NO_ID = [c for c in schemas.TOTE_ROUTER.fieldNames() if c != "id"]


def accept_all(outbox):
    return outbox.filter("id is not null").select("id", "tote_id", F.lit(201).alias("status"))


def state_rows(store):
    return as_set(store.latest().state.select(*schemas.TOTE_ROUTER.fieldNames()))


@pytest.fixture(scope="module")
def extract(spark, tmp_path_factory):
    """The supplied tables as an extract on disk, items in two parts."""
    path = str(tmp_path_factory.mktemp("extract"))
    tables = testdata.tables(spark, SF)
    for name, table in tables.items():
        table.write.parquet(f"{path}/{name}")
    return path


def part_of(spark, extract, folder, number):
    """An extract with every third item missing, another third in each part."""
    items = spark.read.parquet(f"{extract}/tote_detail")
    kept = items.filter(F.pmod(F.xxhash64("tote_id", "inventory_id"), F.lit(3)) != number)
    kept.write.parquet(f"{folder}/tote_detail")
    for name in schemas.WAREHOUSE.keys() - {"tote_detail"}:
        os.symlink(f"{extract}/{name}", f"{folder}/{name}")
    return folder


def test_empty_store(spark, folder):
    store = StateStore(spark, folder("store"))
    first = store.latest()
    assert (first.version, first.last_id, first.state.count()) == (0, 0, 0)
    assert not store.has_run("a")


def test_a_second_run_keeps_everything(spark, extract, folder):
    """All answered, nothing changed, same time: nothing to purge, change or send."""
    store, out = StateStore(spark, folder("store")), folder("out")
    wh = Warehouse.read_extract(spark, extract)
    assert import_state(store, testdata.state(spark, SF), SETTINGS) == 1
    first = run_once(wh, store, SETTINGS, "run-1", out, accept_all)
    assert first.version == 2
    assert expired_routes(store.latest().state, AS_OF).filter("tote_key IS NOT NULL").isEmpty()

    second = RoutingRun(wh, store.latest().state, SETTINGS)
    assert {r["action"] for r in second.reconciled.select("action").distinct().collect()} == {"KEEP"}
    assert second.outbox.isEmpty()
    before = state_rows(store)
    run_once(wh, store, SETTINGS, "run-2", out, accept_all)
    assert state_rows(store) == before


def test_run_leaves_its_tables_and_is_not_repeated(spark, extract, folder):
    store, out = StateStore(spark, folder("store")), folder("out")
    wh = Warehouse.read_extract(spark, extract)
    done = run_once(wh, store, SETTINGS, "run-1", out, accept_all)
    for table in ("reconciled", "pending", "outbox", "acks"):
        assert spark.read.parquet(f"{done.folder}/{table}").count() > 0
    summary = {r["event"]: r["n"] for r in spark.read.json(f"{done.folder}/summary").collect()}
    assert summary["INSERT"] == summary["DISPATCHED"] == summary["ROUTED"]
    again = run_once(wh, store, SETTINGS, "run-1", out, accept_all)
    assert again.skipped and again.version == done.version


def test_import_is_not_repeated_and_never_into_a_used_store(spark, stored, warehouse, folder):
    store, out = StateStore(spark, folder("store")), folder("out")
    old = stored((1, "T1", "HB", 3, 0, AS_OF))
    assert import_state(store, old, SETTINGS) == 1
    wh = warehouse(
        tote_detail=[("T1", "O1")],
        trans=[(1, "pick", None, None, None)],
        trans_detail=[(1, "O1", "1UA-1")],
    )
    run_once(wh, store, SETTINGS, "a", out, accept_all)
    before = state_rows(store)
    assert {row[0] for row in before} == {2}
    assert import_state(store, old, SETTINGS) == 2
    assert state_rows(store) == before
    with pytest.raises(ValueError, match="empty store"):
        import_state(store, old, SETTINGS, "other")
    assert store.latest().last_id == 2


def test_of_two_writers_from_one_snapshot_one_commits(spark, stored, folder, monkeypatch):
    store = StateStore(spark, folder("store"))
    base = store.latest()
    store.commit(base, stored((1, "T1", "FB", 3, 0, None)), "a", 1)
    with pytest.raises(StaleSnapshotError):
        store.commit(base, stored((1, "T2", "FB", 3, 0, None)), "b", 1)
    # Both look before either commits: the name of the version decides.
    monkeypatch.setattr(store, "_newest", lambda: None)
    with pytest.raises(StaleSnapshotError):
        store.commit(base, stored((1, "T2", "FB", 3, 0, None)), "b", 1)
    monkeypatch.undo()
    assert {row[1] for row in state_rows(store)} == {"T1"} and not store.has_run("b")


def test_answers_go_on_the_snapshot_of_a_faster_writer(spark, stored, folder, monkeypatch):
    store = StateStore(spark, folder("store"))
    first = store.commit(store.latest(), stored((1, "T1", "FB", 3, 0, None)), "a", 1)
    real, calls = store.commit, []

    def beaten(based_on, state, run_id, last_id, *rest):
        if not calls:
            calls.append(run_id)
            rows = stored((1, "T1", "FB", 3, 0, None), (2, "T2", "HB", 3, 0, None))
            real(first, rows, "faster", 2)
        return real(based_on, state, run_id, last_id, *rest)

    monkeypatch.setattr(store, "commit", beaten)
    acks = spark.createDataFrame([(1, "T1", 201)], schemas.ACKS)
    assert record_answers(store, acks, SETTINGS, "answers") == 3
    assert {(row[0], row[-1]) for row in state_rows(store)} == {(1, AS_OF), (2, None)}


def test_old_snapshots_expire(spark, stored, folder):
    store = StateStore(spark, folder("store"))
    for n in range(4):
        store.commit(store.latest(), stored((n, "T1", "FB", 3, 0, None)), f"r{n}", n)
    assert store.expire(2) == 2
    assert store.expire(2) == 0
    assert {row[0] for row in state_rows(store)} == {3} and store.has_run("r0")
    with pytest.raises(ValueError):
        store.expire(0)


def test_late_answers_are_kept_with_the_run(spark, warehouse, stored, folder):
    store, out = StateStore(spark, folder("store")), folder("out")
    import_state(store, stored((1, "T9", "FB", 3, 0, AS_OF)), SETTINGS)
    wh = warehouse(
        tote_detail=[("T1", "O1")],
        trans=[(1, "pick", None, None, None)],
        trans_detail=[(1, "O1", "1UA-1")],
    )
    done = run_once(wh, store, SETTINGS, "a", out, no_answers)
    acks = spark.createDataFrame([(2, "T1", 201), (None, "T9", 500)], schemas.ACKS)
    record_answers(store, acks, SETTINGS, "a/answers", done.folder)
    summary = spark.read.json(f"{done.folder}/answers/*/summary")
    assert as_set(summary) == {("ROUTED", 1), ("COMPLETION_FAILED", 1)}
    assert spark.read.parquet(f"{done.folder}/answers/*/acks").count() == 2


def test_a_run_that_dies_changes_nothing(spark, extract, folder):
    store, out = StateStore(spark, folder("store")), folder("out")
    wh = Warehouse.read_extract(spark, extract)

    def dies(outbox):
        raise OSError("no conveyor")

    with pytest.raises(OSError):
        run_once(wh, store, SETTINGS, "run-1", out, dies)
    assert store.latest().version == 0
    assert run_once(wh, store, SETTINGS, "run-1", out, accept_all).version == 1


def test_ids_are_never_given_twice(spark, warehouse, folder):
    store, out = StateStore(spark, folder("store")), folder("out")
    picks = {"trans": [(1, "pick", None, None, None)], "trans_detail": [(1, "O1", "1UA-1")]}
    one = warehouse(tote_detail=[("T1", "O1")], **picks)
    other = warehouse(tote_detail=[("T2", "O1")], **picks)
    run_once(one, store, SETTINGS, "a", out, accept_all)
    run_once(warehouse(**picks), store, SETTINGS, "b", out, accept_all)
    assert state_rows(store) == set()
    run_once(other, store, SETTINGS, "c", out, accept_all)
    assert {row[0] for row in state_rows(store)} == {2}


def test_unanswered_routes_are_sent_again_and_expire_after_an_hour(spark, warehouse, folder):
    store, out = StateStore(spark, folder("store")), folder("out")
    wh = warehouse(
        tote_detail=[("T1", "O1")],
        trans=[(1, "pick", None, None, None)],
        trans_detail=[(1, "O1", "1UA-1")],
    )
    run_once(wh, store, SETTINGS, "a", out, no_answers)
    again = run_once(wh, store, SETTINGS, "b", out, no_answers)
    sent = spark.read.parquet(f"{again.folder}/outbox").collect()
    assert [(r["id"], r["kind"]) for r in sent] == [(1, "ROUTE")]

    acks = spark.createDataFrame([(1, "T1", 201)], schemas.ACKS)
    version = record_answers(store, acks, SETTINGS, "b/answers")
    assert state_rows(store) == {(1, "T1", "FB", 3, 0, AS_OF)}
    assert record_answers(store, acks, SETTINGS, "b/answers") == version

    later = replace(SETTINGS, as_of=AS_OF + timedelta(hours=1))
    run_once(wh, store, later, "c", out, no_answers)
    assert {row[0] for row in state_rows(store)} == {1}
    run_once(wh, store, replace(later, as_of=later.as_of + timedelta(seconds=1)), "d", out, no_answers)
    assert state_rows(store) == {(2, "T1", "FB", 3, 0, None)}


def one_tote(warehouse, tote="T1", location="1UA-1"):
    return warehouse(
        tote_detail=[(tote, "O1")],
        trans=[(1, "pick", None, None, None)],
        trans_detail=[(1, "O1", location)],
    )


def test_answers_may_have_the_id_of_their_run(spark, warehouse, folder):
    store, out = StateStore(spark, folder("store")), folder("out")
    done = run_once(one_tote(warehouse), store, SETTINGS, "run-17", out, no_answers)
    acks = spark.createDataFrame([(1, "T1", 201)], schemas.ACKS)
    assert record_answers(store, acks, SETTINGS, "run-17", done.folder) == 2
    assert state_rows(store) == {(1, "T1", "FB", 3, 0, AS_OF)}
    assert record_answers(store, acks, SETTINGS, "run-17", done.folder) == 2
    again = run_once(one_tote(warehouse), store, SETTINGS, "run-17", out, no_answers)
    assert again.skipped
    other = spark.createDataFrame([(1, "T1", 500)], schemas.ACKS)
    with pytest.raises(ValueError, match="other content"):
        record_answers(store, other, SETTINGS, "run-17")


def test_of_two_runs_at_a_time_one_sends_and_its_ids_are_committed(spark, warehouse, folder):
    """The second starts while the first one delivers."""
    store, out, sent = StateStore(spark, folder("store")), folder("out"), []
    wh, other = one_tote(warehouse), one_tote(warehouse, "T2")

    def second(outbox):
        sent.append("second")
        return accept_all(outbox)

    def first(outbox):
        with pytest.raises(StaleSnapshotError, match="reserved"):
            run_once(other, store, SETTINGS, "b", out, second)
        sent.append("first")
        return accept_all(outbox)

    run_once(wh, store, SETTINGS, "a", out, first)
    assert sent == ["first"]
    assert state_rows(store) == {(1, "T1", "FB", 3, 0, AS_OF)}
    run_once(other, store, SETTINGS, "b", out, second)
    assert sent == ["first", "second"]
    assert {row[:2] for row in state_rows(store)} == {(2, "T2")}


def test_a_faster_writer_makes_a_run_plan_anew_before_it_sends(spark, warehouse, stored, folder, monkeypatch):
    store, out, sent = StateStore(spark, folder("store")), folder("out"), []
    real = store.reserve

    def beaten(based_on, run_id, last_id):
        if based_on.version == 0:
            store.commit(based_on, stored((7, "T9", "HB", 3, 0, None)), "faster", 7)
        real(based_on, run_id, last_id)

    monkeypatch.setattr(store, "reserve", beaten)

    def deliver(outbox):
        sent.extend(sorted((r["id"] or 0, r["tote_id"]) for r in outbox.collect()))
        return accept_all(outbox)

    run_once(one_tote(warehouse), store, SETTINGS, "a", out, deliver)
    assert sent == [(0, "T9"), (8, "T1")]
    assert state_rows(store) == {(8, "T1", "FB", 3, 0, AS_OF)}


def test_ids_of_a_run_that_died_while_sending_are_not_given_to_others(spark, warehouse, folder):
    store, out = StateStore(spark, folder("store")), folder("out")

    def dies(outbox):
        raise OSError("no conveyor")

    with pytest.raises(OSError):
        run_once(one_tote(warehouse), store, SETTINGS, "a", out, dies)
    with pytest.raises(StaleSnapshotError, match="'a'"):
        run_once(one_tote(warehouse, "T2"), store, SETTINGS, "b", out, accept_all)
    assert not store.release("b") and store.release("a") and not store.release("a")
    run_once(one_tote(warehouse, "T2"), store, SETTINGS, "b", out, accept_all)
    assert {row[:2] for row in state_rows(store)} == {(2, "T2")}
    assert store.latest().last_id == 2


def test_only_parts_of_changed_totes_are_written(spark, warehouse, stored, folder):
    store, out = StateStore(spark, folder("store"), parts=8), folder("out")
    old = [(n, f"T{n}", "FB", 3, 0, AS_OF) for n in range(1, 60)]
    import_state(store, stored(*old), SETTINGS)
    before = store.latest()
    assert sorted(before.folders) == list(range(8))
    wh = warehouse(
        tote_detail=[(f"T{n}", "O1") for n in range(1, 60) if n != 7] + [("T1", "O2")],
        trans=[(1, "pick", None, None, None)],
        trans_detail=[(1, "O1", "1UA-1"), (1, "O2", "1VG-1")],
    )
    run_once(wh, store, SETTINGS, "a", out, accept_all)
    after = store.latest()
    totes = spark.createDataFrame([("T1",), ("T7",)], "tote_key string")
    touched = set(store.changed_parts(before, totes))
    assert 0 < len(touched) < 8
    assert {n for n in range(8) if after.folders.get(n) != before.folders[n]} == touched
    want = {row for row in old if row[1] not in ("T1", "T7")} | {(60, "T1", "FB-HB", 3, 0, AS_OF)}
    assert state_rows(store) == want
    answers = spark.createDataFrame([(1000, "T1", 500)], schemas.ACKS)
    record_answers(store, answers, SETTINGS, "none accepted")
    assert store.latest().folders == after.folders and state_rows(store) == want
    assert store.expire(1) == len(touched) and state_rows(store) == want


def test_parts_of_a_writer_that_lost_are_removed(spark, stored, folder, monkeypatch):
    store = StateStore(spark, folder("store"))
    base = store.latest()
    store.commit(base, stored((1, "T1", "FB", 3, 0, None)), "a", 1)
    monkeypatch.setattr(store, "_newest", lambda: None)
    with pytest.raises(StaleSnapshotError):
        store.commit(base, stored((1, "T2", "FB", 3, 0, None)), "b", 1)
    monkeypatch.undo()
    assert store.expire(5) == 1
    assert {row[1] for row in state_rows(store)} == {"T1"}


def test_two_spellings_of_a_zone_do_not_change_a_route(spark, warehouse, folder):
    """Once the pick at the location that spells it one way is done, the other way is left."""
    store, out = StateStore(spark, folder("store")), folder("out")
    zones = {
        "zone": [("CC", 1), ("DD", 1)],
        "zone_locations": [("M1", "CC"), ("M2", "cc"), ("M3", "DD")],
        "trans": [(1, "pick", None, None, None)],
        "tote_detail": [("T1", "O1")],
    }
    lines = [(1, "O1", "M1"), (1, "O1", "M2"), (1, "O1", "M3")]
    run_once(warehouse(trans_detail=lines, **zones), store, SETTINGS, "a", out, accept_all)
    assert state_rows(store) == {(1, "T1", "CC-DD", 3, 0, AS_OF)}
    again = RoutingRun(warehouse(trans_detail=lines[1:], **zones), store.latest().state, SETTINGS)
    rows = again.reconciled.collect()
    assert [(r["action"], r["route"]) for r in rows] == [("KEEP", "cc-DD")]
    assert again.outbox.isEmpty()


def test_stream_equals_batch_runs(spark, extract, folder, tmp_path):
    parts = [part_of(spark, extract, folder(f"part{n}"), n) for n in range(3)]
    times = [AS_OF + timedelta(minutes=50 * n) for n in range(3)]

    batch = StateStore(spark, folder("batch-store"))
    for n, (part, at) in enumerate(zip(parts, times, strict=True)):
        wh = Warehouse.read_extract(spark, part)
        run_once(wh, batch, RouterSettings(at), f"r{n}", folder("batch-out"), testdata.acknowledge)

    requests = tmp_path / "requests"
    requests.mkdir()
    store, out, checkpoint = folder("stream-store"), folder("stream-out"), folder("checkpoint")

    def request(n):
        row = {"run_id": f"r{n}", "as_of": times[n].isoformat(), "extract": parts[n]}
        (requests / f"{n}.json").write_text(json.dumps(row))

    def follow():
        query = start_router(
            spark, str(requests), store, out, checkpoint, SETTINGS, testdata.acknowledge
        )
        query.awaitTermination(300)
        assert query.exception() is None

    request(0)
    follow()
    request(1)
    request(2)
    follow()
    stream = StateStore(spark, store)
    assert stream.latest().version == batch.latest().version == 3
    assert state_rows(stream) == state_rows(batch)


def test_canonical_form_gives_the_same_routes(spark, extract, folder):
    path = folder("canonical")
    wh = Warehouse.read_extract(spark, extract)
    wh.write_canonical(path)
    stored = testdata.state(spark, SF)
    plain = RoutingRun(wh, stored, SETTINGS).reconciled
    canonical = RoutingRun(Warehouse.read_canonical(spark, path), stored, SETTINGS).reconciled
    assert as_set(plain) == as_set(canonical)


def test_command_line(spark, extract, folder, capsys, monkeypatch):
    monkeypatch.setattr("totelane.__main__.build_session", lambda: spark)
    store, out, acks = folder("store"), folder("out"), folder("acks")
    shared = ["--store", store, "--as-of", AS_OF.isoformat()]
    old, imported = folder("old"), folder("imported")
    testdata.state_table(spark, SF).write.parquet(old)
    main(["import", "--store", imported, "--state", old])
    assert "state version 1" in capsys.readouterr().out
    assert StateStore(spark, imported).latest().state.count() == 1500
    taken, sent = folder("taken"), folder("sent")
    main(["ingest", "--extract", extract, "--out", taken])
    run = ["run", *shared, "--extract", taken, "--canonical", "--out", out, "--run-id", "a"]
    main([*run, "--conveyor", sent])
    assert "state version 1" in capsys.readouterr().out
    rows = StateStore(spark, store).latest().state
    assert spark.read.format("conveyor").load(sent).count() == rows.filter("route is not null").count()
    main(["release", "--store", store, "--run-id", "a"])
    assert "no reservation" in capsys.readouterr().out
    pending = StateStore(spark, store).latest().state
    accept_all(pending).write.parquet(acks)
    main(["answers", *shared, "--acks", acks, "--run-id", "a/answers"])
    assert "state version 2" in capsys.readouterr().out
    assert {r[-1] for r in state_rows(StateStore(spark, store))} == {AS_OF}


def test_properties_of_a_whole_run(spark):
    """Actions part the totes, routes without stops take chute 4, states keep one row a tote."""
    run = RoutingRun(testdata.warehouse(spark, SF), testdata.state(spark, SF), SETTINGS)
    rows = run.settled.collect()
    assert len({r["tote_key"] for r in rows}) == len(rows)
    planned = [r for r in rows if r["action"] != "COMPLETE"]
    assert all((r["chute"] == 4) == (r["route"] == "-") for r in planned)
    assert {r["chute"] for r in rows if r["action"] == "COMPLETE"} <= {1, 4}

    doubled = {r["tote_key"] for r in rows if r["action"] == "INSERT_ON_BLANK"}
    held = {}
    for row in run.next_state.collect():
        held.setdefault(row["tote_key"], []).append(row["id"])
    assert {tote for tote, ids in held.items() if tote and len(ids) > 1} == doubled
    ids = [one for many in held.values() for one in many]
    assert len(ids) == len(set(ids))
    new = run.inserts.orderBy("id").collect()
    assert [r["id"] for r in new] == list(range(run.last_id + 1, run.last_id + 1 + len(new)))
    assert [r["tote_key"] for r in new] == sorted(r["tote_key"] for r in new)
    assert run.tote_zones.filter("zone is null").isEmpty()


def test_a_taken_in_extract_is_measured_once(spark, extract, folder, monkeypatch):
    """Its sketches are combined per run; planning reads the large tables for routing only."""
    path = folder("taken")
    wh = Warehouse.read_extract(spark, extract)
    stored = testdata.state(spark, SF)
    settings = RouterSettings(AS_OF, ("SINGLE", "PUTAWAY"), skew=SkewSettings(min_rows=0, fair_shares=1e-9))
    plain = RoutingRun(wh, stored, settings)
    want, hot = as_set(plain.reconciled), plain.measures
    taken = take_in(wh, path)

    def again(*_):
        raise AssertionError("a large table is measured again")

    monkeypatch.setattr(skew, "sketches", again)
    run = RoutingRun(taken_in(spark, path), stored, settings)
    assert sorted(run.measures.lines) == sorted(hot.lines)
    assert {k: sorted(v) for k, v in run.measures.items.items()} == {
        k: sorted(v) for k, v in hot.items.items()
    }
    monkeypatch.undo()
    assert as_set(RoutingRun(taken, stored, settings).reconciled) == want
    with pytest.raises(FileExistsError):
        take_in(wh, path)


def test_a_piece_counts_when_it_is_whole(spark, lines_of, folder, monkeypatch):
    path = folder("taken")
    take_in(lines_of("1UA-1"), path)
    monkeypatch.setattr(measures, "together", lambda *_: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        take_in(lines_of("1VG-1"), path, append=True)
    monkeypatch.undo()
    assert taken_in(spark, path).trans_detail.count() == 1
    grown = take_in(lines_of("1VG-1"), path, append=True)
    assert as_set(grown.trans_detail.select("location_key")) == {("1UA-1",), ("1VG-1",)}
    assert grown.kept["lines"].agg(F.sum("_rows")).first()[0] == 2


@pytest.fixture
def lines_of(warehouse):
    return lambda location: warehouse(trans_detail=[(1, "O1", location)])


def test_items_are_worked_out_once_for_the_measures_and_the_plan(spark, warehouse):
    worked_out = spark.sparkContext.accumulator(0)

    def counted(name):
        worked_out.add(1)
        return name

    wh = warehouse(
        tote_detail=[("T1", "O1"), ("T2", "O1"), (None, "O1")],
        trans=[(1, "pick", None, None, None)],
        trans_detail=[(1, "O1", "1UA-1")],
    )
    count = F.udf(counted).asNondeterministic()
    wh = replace(wh, tote_detail=wh.tote_detail.withColumn("tote_id", count("tote_id")))
    run = RoutingRun(wh, None, RouterSettings(AS_OF))
    assert run.measures.items == {"inventory_key": []}
    made = worked_out.value
    assert made > 0
    assert {(row["tote_key"], row["route"]) for row in run.preroutes.collect()} == {("T1", "FB"), ("T2", "FB")}
    assert worked_out.value == made
