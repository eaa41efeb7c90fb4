"""One routing run: purge, plan, reconcile, dispatch, mark."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from totelane.operators import dispatch, reconcile, routes, state as stored
from totelane.operators.dispatch import no_answers
from totelane.operators.measures import Measures, measure
from totelane.operators.numbering import number_rows
from totelane.operators.skew import together
from totelane.session import durable, durable_counted
from totelane.settings import RouterSettings
from totelane.sources.state_store import ANSWERS, StaleSnapshotError, StateStore
from totelane.sources.warehouse import Warehouse


__all__ = [
    "RoutingRun", "RunResult", "import_state", "no_answers", "record_answers", "run_once",
]


class RoutingRun:
    """The frames of one run, each built on first use.

    Frames are lazy, except for four that are written once: the reconciled totes and the
    pending routes, which several frames start from, and the new rows and the outbox, whose
    numbers must not change between two uses. ``folder`` keeps them for audit; without it they
    go to the shared folder. The next state is not written here: a run writes the parts of it
    that it changes, see ``rows_of``. ``zone_sets`` are the zones of open totes where they are
    kept up to date elsewhere, as by ``streaming.increments``; the large tables are not read then.
    """

    def __init__(
        self,
        warehouse: Warehouse,
        state: DataFrame,
        settings: RouterSettings,
        last_id: int = 0,
        folder: str | None = None,
        zone_sets: DataFrame | None = None,
    ):
        if zone_sets is not None:
            self.zone_sets = zone_sets
        self._plans = zone_sets is None
        self.warehouse, self.state, self.settings = warehouse, state, settings
        self._last_id, self.folder = last_id, folder
        #: Rows per event that were counted while tables of the run were written.
        self._counts: dict[str, int] = {}

    def _path(self, name: str) -> str | None:
        return f"{self.folder}/{name}" if self.folder else None

    @cached_property
    def measures(self) -> Measures:
        return measure(self.warehouse, self.settings)

    @cached_property
    def state_measures(self) -> stored.StateMeasures:
        return stored.measure_state(self.state, self.settings.skew)

    @cached_property
    def zone_sets(self) -> DataFrame:
        return routes.tote_zone_sets(self.warehouse, self.settings, self.measures)

    @cached_property
    def tote_zones(self) -> DataFrame:
        return routes.tote_zones(self.zone_sets)

    @cached_property
    def tote_routes(self) -> DataFrame:
        return routes.tote_routes(self.zone_sets)

    @cached_property
    def preroutes(self) -> DataFrame:
        return routes.planned_routes(self.tote_routes)

    @cached_property
    def expired(self) -> DataFrame:
        return stored.expired_totes(self.state, self.settings.as_of)

    @cached_property
    def stored_routes(self) -> DataFrame:
        return stored.stored_routes(self.state, self.settings.as_of)

    @cached_property
    def reconciled(self) -> DataFrame:
        return reconcile.route_reconcile(self.zone_sets, self.stored_routes)

    @cached_property
    def settled(self) -> DataFrame:
        """``reconciled`` written once: four later frames start from it."""
        spark = self.state.sparkSession
        measured = [lambda: self.measures] if self._plans else []
        together(spark, *measured, lambda: self.state_measures)
        counts = [F.count_if(F.col("action") == x).alias(x) for x in reconcile.ACTIONS]
        rows, found = durable_counted(self.reconciled, self._path("reconciled"), *counts)
        self._counts |= found
        return rows

    @property
    def last_id(self) -> int:
        """Highest id in use before the run."""
        return max(self.state_measures.last_id, self._last_id)

    @cached_property
    def inserts(self) -> DataFrame:
        """New rows with their ids, in order of tote. They start from the written table,
        because sorting reads its input twice."""
        rows = reconcile.new_rows(self.settled)
        placed = number_rows(rows, [F.col("tote_key").asc()], "position", self._path("inserts"))
        return reconcile.state_inserts(placed, self.last_id)

    @cached_property
    def removed(self) -> DataFrame:
        """Totes whose stored rows leave the state."""
        return reconcile.removed_totes(self.settled, self.expired)

    def _after(self, state: DataFrame, inserts: DataFrame) -> DataFrame:
        kept = stored.without_totes(state, self.removed, self.state_measures.hot)
        return kept.unionByName(inserts)

    @cached_property
    def next_state(self) -> DataFrame:
        return self._after(self.state, self.inserts)

    @cached_property
    def pending(self) -> DataFrame:
        """Rows of the next state that were not sent; the outbox and the summary start from
        them. Stored rows that were sent are filtered where they are read."""
        waiting = self._after(stored.pending_routes(self.state), self.inserts)
        held = F.count_if(F.col("route").isNull()).alias("HELD_WITHOUT_ROUTE")
        rows, found = durable_counted(waiting, self._path("pending"), held)
        self._counts |= found
        return rows

    @cached_property
    def outbox(self) -> DataFrame:
        return dispatch.dispatch_outbox(self.settled, self.pending, self._path("outbox"))

    def marked(self, acks: DataFrame) -> DataFrame:
        return dispatch.mark_routed(self.next_state, acks, self.settings.as_of)

    def changed_totes(self, acks: DataFrame) -> DataFrame:
        """Totes with rows that the run adds, removes or marks."""
        added = self.settled.filter(F.col("action").isin(*reconcile.NEW_ROW_ACTIONS))
        parts = [added, self.removed, dispatch.accepted_totes(acks)]
        return reduce(DataFrame.unionByName, [x.select("tote_key") for x in parts])

    def rows_of(self, state: DataFrame, acks: DataFrame) -> DataFrame:
        """The next state of parts that hold all totes the run changes; ``state`` is what was
        stored in these."""
        return dispatch.mark_routed(self._after(state, self.inserts), acks, self.settings.as_of)

    def summary(self, acks: DataFrame) -> DataFrame:
        """Number of rows per event of the run; events that did not occur are left out. What
        the run wrote was counted then, the rest is counted here."""

        def events(df: DataFrame, name) -> DataFrame:
            return df.select((F.lit(name) if isinstance(name, str) else name).alias("event"))

        parts = [
            events(stored.expired_routes(self.state, self.settings.as_of), "EXPIRED"),
            dispatch.outbox_events(self.outbox, acks),
            events(stored.rejected_rows(self.warehouse.tote_detail, self.state), "REJECTED"),
        ]
        occurred = reduce(DataFrame.unionByName, parts)
        counted = occurred.groupBy("event").agg(F.count(F.lit(1)).alias("n"))
        written = [(event, n) for event, n in self._counts.items() if n]
        return counted.unionByName(
            self.state.sparkSession.createDataFrame(written, "event string, n bigint")
        )


@dataclass(frozen=True)
class RunResult:
    """``folder`` holds ``reconciled``, ``inserts``, ``outbox``, ``acks`` and ``summary``."""

    run_id: str
    version: int
    folder: str | None
    skipped: bool = False


Deliver = Callable[[DataFrame], DataFrame]
_ATTEMPTS = 5


def run_once(
    warehouse: Warehouse,
    store: StateStore,
    settings: RouterSettings,
    run_id: str,
    folder: str,
    deliver: Deliver,
) -> RunResult:
    """A whole run against the state store.

    ``deliver`` gets the outbox and returns the conveyor's answers (``id``, ``tote_id``,
    ``status``); it is evaluated once. The next version and the ids in the outbox are reserved
    before it is called, so of two runs at a time only one sends, and it can commit; the other
    plans anew on its snapshot. A committed run is not repeated, and each attempt writes to a
    folder of its own, so a run that died can simply be started again.
    """
    for attempt in range(1, _ATTEMPTS + 1):
        if store.has_run(run_id):
            return RunResult(run_id, store.latest().version, None, skipped=True)
        before = store.latest()
        folder_of = f"{folder.rstrip('/')}/{run_id}/{uuid.uuid4().hex[:8]}"
        run = RoutingRun(warehouse, before.state, settings, before.last_id, folder_of)
        outbox = run.outbox
        last_id = run.inserts.agg(F.max("id")).first()[0] or run.last_id
        try:
            store.reserve(before, run_id, last_id)
            break
        except StaleSnapshotError:
            if attempt == _ATTEMPTS:
                raise
    acks = durable(deliver(outbox), f"{folder_of}/acks")
    run.summary(acks).coalesce(1).write.mode("error").json(f"{folder_of}/summary")
    changed = store.changed_parts(before, run.changed_totes(acks))
    rows = run.rows_of(store.state_of(before, changed), acks)
    after = store.commit(before, rows, run_id, last_id, changed)
    return RunResult(run_id, after.version, folder_of)


def import_state(
    store: StateStore, state: DataFrame, settings: RouterSettings, run_id: str = "import"
) -> int:
    """Take over the routes of an existing state table into an empty store; the new version.
    A committed import is not repeated."""
    before = store.latest()
    if store.has_run(run_id):
        return before.version
    if before.version:
        raise ValueError("an existing table can only be imported into an empty store")
    last_id = stored.measure_state(state, settings.skew).last_id
    return store.commit(before, state, run_id, max(before.last_id, last_id)).version


def record_answers(
    store: StateStore,
    acks: DataFrame,
    settings: RouterSettings,
    run_id: str,
    run_folder: str | None = None,
) -> int:
    """Mark the routes the conveyor accepted since the last snapshot; the new version.

    Ids of answers are their own: those of runs do not matter, and a repeated call changes
    nothing, but other answers under an id that was used are an error. ``run_folder``, the
    folder of the run that sent the messages, gets the answers and what came of each message,
    last messages too, under ``answers``, before anything is marked. Where another writer was
    faster, the marks are made on its snapshot. Only parts with accepted totes are written.
    """
    content = _fingerprint(acks)
    if store.has_run(run_id, ANSWERS, content):
        return store.latest().version
    if run_folder:
        outbox = acks.sparkSession.read.parquet(f"{run_folder}/outbox")
        folder = f"{run_folder}/answers/{uuid.uuid4().hex[:8]}"
        acks.write.mode("error").parquet(f"{folder}/acks")
        counts = dispatch.answer_events(outbox, acks).groupBy("event").agg(
            F.count(F.lit(1)).alias("n")
        )
        counts.coalesce(1).write.mode("error").json(f"{folder}/summary")
    for attempt in range(1, _ATTEMPTS + 1):
        before = store.latest()
        if store.has_run(run_id, ANSWERS, content):
            return before.version
        changed = store.changed_parts(before, dispatch.accepted_totes(acks))
        state = store.state_of(before, changed)
        marked = dispatch.mark_routed(state, acks, settings.as_of)
        try:
            return store.commit(
                before, marked, run_id, before.last_id, changed, ANSWERS, content
            ).version
        except StaleSnapshotError:
            if attempt == _ATTEMPTS:
                raise
    raise AssertionError("unreachable")


def _fingerprint(acks: DataFrame) -> str:
    """Rows of the answers and a sum over them, whatever their order."""
    found = acks.agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("id", "tote_id", "status")).alias("bits"),
        F.sum(F.shiftright(F.xxhash64("id", "tote_id", "status"), 20)).alias("total"),
    ).first()
    return f"{found['n']}-{found['bits']}-{found['total']}"
