"""Every operator as a query over the supplied tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from totelane.functions import fixed
from totelane.functions.locations import order_destination, zone_by_rule
from totelane.functions.routes import rewrite_route, route_chute
from totelane.operators import (
    destinations,
    dispatch,
    measures,
    picks,
    routes,
    rules,
    state,
    zones,
)
from totelane.operators.skew import together
from totelane.plans import streams
from totelane.plans.run import RoutingRun, import_state
from totelane.session import shared_folder
from totelane.settings import PUTAWAY, SINGLE, RouterSettings, SkewSettings
from totelane.sources import testdata
from totelane.sources.state_store import StateStore
from totelane.sources.warehouse import Warehouse
from totelane.streaming.router import REQUESTS, start_router

Query = Callable[[SparkSession, str], DataFrame]

SETTINGS = RouterSettings(as_of=testdata.AS_OF)
ALL_STATES = RouterSettings(as_of=testdata.AS_OF, states=(SINGLE, PUTAWAY))
PUTAWAY_ONLY = RouterSettings(as_of=testdata.AS_OF, states=(PUTAWAY,))
LEGACY = RouterSettings(as_of=testdata.AS_OF, random_mode="legacy")
# Every key that occurs more than once may be split, and no table is broadcast.
SPLIT = SkewSettings(min_rows=0, fair_shares=1e-9, broadcast_rows=0)
ALL_SPLIT = RouterSettings(as_of=testdata.AS_OF, states=(SINGLE, PUTAWAY), skew=SPLIT)
SINGLE_SPLIT = RouterSettings(as_of=testdata.AS_OF, skew=SPLIT)

STATE_COLUMNS = ["id", "tote_id", "route", "chute", "noncon", "routed_date"]
REPORT_COLUMNS = ["tote_key", "tote_id", "origroute", "route", "chute", "noncon"]


def _run(spark: SparkSession, sf_dir: str, settings: RouterSettings = SETTINGS) -> RoutingRun:
    return RoutingRun(testdata.warehouse(spark, sf_dir), testdata.state(spark, sf_dir), settings)


def _moves(spark: SparkSession, sf_dir: str, kind: str, location: str) -> DataFrame:
    trans = testdata.warehouse(spark, sf_dir).trans
    return (
        trans.filter((F.col("tran_type") == kind) & (F.col("inventory_key") > ""))
        .select("inventory_key", F.col(location).alias("location_key"))
        .distinct()
    )


def pick_locations(spark, sf_dir):
    wh = testdata.warehouse(spark, sf_dir)
    return picks.pick_locations(wh, picks.hot_transactions(wh, SETTINGS.skew))


def replenishments(spark, sf_dir):
    return _moves(spark, sf_dir, fixed.REPLENISH, "to_location_key")


def putaways(spark, sf_dir):
    return _moves(spark, sf_dir, fixed.PUT_AWAY, "location_key")


def home_locations(spark, sf_dir):
    return testdata.warehouse(spark, sf_dir).multi_home_loc.distinct()


def order_destinations(spark, sf_dir):
    orders = testdata.warehouse(spark, sf_dir).orders
    return orders.select(
        "order_key", order_destination(F.col("status_key")).alias("location_key")
    ).distinct()


def tote_destinations(spark, sf_dir, settings=ALL_STATES):
    wh, states, skew = testdata.warehouse(spark, sf_dir), settings.states, settings.skew
    lines, items = together(
        spark,
        lambda: picks.hot_transactions(wh, skew),
        lambda: measures.hot_items(wh, states, skew),
    )
    return destinations.tote_destinations(wh, states, lines, items, skew)


def tote_destinations_split(spark, sf_dir):
    return tote_destinations(spark, sf_dir, ALL_SPLIT)


def destination_levels(spark, sf_dir):
    return (
        tote_destinations(spark, sf_dir)
        .groupBy("dest_level", "tote_state")
        .agg(F.count(F.lit(1)).alias("destinations"))
    )


def location_zone_map(spark, sf_dir):
    return zones.location_zone_map(testdata.warehouse(spark, sf_dir), SETTINGS.skew)


def zone_rules(spark, sf_dir):
    locations = pick_locations(spark, sf_dir).select("location_key").distinct()
    return locations.select("location_key", zone_by_rule(F.col("location_key")).alias("zone"))


def zone_by_rule_table(spark, sf_dir):
    """Locations of open picks by the fixed rules as a table and, after these, by a range for
    every part; many of the ranges overlap."""
    locations = pick_locations(spark, sf_dir).select("location_key").distinct()
    listed = testdata.warehouse(spark, sf_dir).zone_locations.filter(F.col("location_key").isNotNull())
    other = F.reverse(F.col("location_key"))
    ranges = listed.groupBy("location_key").agg(F.min("zone").alias("zone"), F.count("*").alias("n"))
    ranges = ranges.select(
        F.least("location_key", other).alias("low"),
        F.greatest("location_key", other).alias("high"),
        "zone",
        (F.col("n") + 100).alias("rank"),
    )
    fixed_rules = rules.floor_rules(spark).withColumn("high", F.concat("high", F.lit("~")))
    found = rules.first_rules(
        locations.withColumnRenamed("location_key", "code"), fixed_rules.unionByName(ranges)
    )
    return found.withColumnRenamed("code", "location_key")


def random_zone_spread(spark, sf_dir):
    run = _run(spark, sf_dir, ALL_STATES)
    return routes.spread_totes(run.warehouse, run.settings, run.measures)


def tote_zones(spark, sf_dir):
    return _run(spark, sf_dir).tote_zones


def tote_zones_all_states(spark, sf_dir):
    return _run(spark, sf_dir, ALL_STATES).tote_zones


def tote_routes(spark, sf_dir):
    return _run(spark, sf_dir).tote_routes.select("tote_key", "origroute")


def route_rewrite(spark, sf_dir):
    origroutes = _run(spark, sf_dir).tote_routes.groupBy("origroute").agg(
        F.count(F.lit(1)).alias("totes")
    )
    return routes.planned_routes(origroutes).select("origroute", "route", "noncon", "totes")


def chute_assignment(spark, sf_dir):
    route = rewrite_route(F.col("origroute"))
    return (
        _run(spark, sf_dir)
        .tote_routes.select("tote_key", route_chute(route).alias("chute"))
        .groupBy("chute")
        .agg(F.count(F.lit(1)).alias("totes"))
    )


def preroute_report(spark, sf_dir):
    return _run(spark, sf_dir).preroutes.select(*REPORT_COLUMNS)


def preroute_report_all_states(spark, sf_dir):
    return _run(spark, sf_dir, ALL_STATES).preroutes.select(*REPORT_COLUMNS)


def preroute_report_putaway(spark, sf_dir):
    return _run(spark, sf_dir, PUTAWAY_ONLY).preroutes.select(*REPORT_COLUMNS)


def preroute_report_legacy(spark, sf_dir):
    return _run(spark, sf_dir, LEGACY).preroutes.select(*REPORT_COLUMNS)


def expired_routes(spark, sf_dir):
    expired = state.expired_routes(testdata.state(spark, sf_dir), SETTINGS.as_of)
    return expired.select("id", "tote_key", "routed_date")


def pending_routes(spark, sf_dir):
    return state.pending_routes(testdata.state(spark, sf_dir)).select(
        "id", "tote_id", "route", "chute"
    )


def state_after_purge(spark, sf_dir):
    rows = testdata.state(spark, sf_dir)
    hot = state.measure_state(rows, SETTINGS.skew).hot
    return state.state_after_purge(rows, SETTINGS.as_of, hot).select(*STATE_COLUMNS)


def stored_route_lookup(spark, sf_dir):
    stored = _run(spark, sf_dir).stored_routes
    return stored.select("tote_key", "stored_id", "stored_route", "stored_noncon")


def open_vs_state(spark, sf_dir):
    run = _run(spark, sf_dir)
    return state.open_vs_state(run.tote_zones, run.stored_routes, F.lit(SINGLE))


def completed_totes(spark, sf_dir):
    run = _run(spark, sf_dir)
    return state.completed_totes(run.stored_routes, run.zone_sets)


def lost_completions(spark, sf_dir):
    run = _run(spark, sf_dir)
    return state.lost_completions(run.expired, run.zone_sets)


def rejected_rows(spark, sf_dir):
    run = _run(spark, sf_dir)
    return state.rejected_rows(run.warehouse.tote_detail, run.state)


def route_reconcile(spark, sf_dir):
    return _run(spark, sf_dir).reconciled


def route_reconcile_split(spark, sf_dir):
    return _run(spark, sf_dir, SINGLE_SPLIT).reconciled


def next_state_split(spark, sf_dir):
    return _run(spark, sf_dir, SINGLE_SPLIT).next_state.select(*STATE_COLUMNS)


def preroute_report_all_states_split(spark, sf_dir):
    return _run(spark, sf_dir, ALL_SPLIT).preroutes.select(*REPORT_COLUMNS)


def state_inserts(spark, sf_dir):
    return _run(spark, sf_dir).inserts.select(*STATE_COLUMNS)


def next_state(spark, sf_dir):
    return _run(spark, sf_dir).next_state.select(*STATE_COLUMNS)


def dispatch_outbox(spark, sf_dir):
    return _run(spark, sf_dir).outbox.select(
        "seq", "kind", "id", "tote_id", "path", "chute", "payload"
    )


def accepted_answers(spark, sf_dir):
    return dispatch.accepted(testdata.acknowledge(_run(spark, sf_dir).outbox))


def failed_dispatches(spark, sf_dir):
    outbox = _run(spark, sf_dir).outbox
    return dispatch.failed_dispatches(outbox, testdata.acknowledge(outbox))


def mark_routed(spark, sf_dir):
    run = _run(spark, sf_dir)
    return run.marked(testdata.acknowledge(run.outbox)).select(*STATE_COLUMNS)


def taken_in_report(spark, sf_dir):
    """The planned routes from an extract that was taken in by two pieces, with its sketches."""
    path = f"{shared_folder(spark)}/totelane/{uuid.uuid4().hex}"
    tables = testdata.tables(spark, sf_dir)
    half = F.pmod(F.xxhash64("tran_id", "location_id"), F.lit(2)) == 0
    for n, kept in enumerate((half, ~half)):
        rows = tables["trans_detail"].filter(kept)
        rest = tables if n == 0 else {k: v.filter(F.lit(False)) for k, v in tables.items()}
        wh = measures.take_in(Warehouse.from_tables({**rest, "trans_detail": rows}), path, bool(n))
    return RoutingRun(wh, testdata.state(spark, sf_dir), SETTINGS).preroutes.select(*REPORT_COLUMNS)


def run_summary(spark, sf_dir):
    path = f"{shared_folder(spark)}/totelane/{uuid.uuid4().hex}"
    wh = measures.take_in(testdata.warehouse(spark, sf_dir), path)
    run = RoutingRun(wh, testdata.state(spark, sf_dir), SETTINGS)
    return run.summary(testdata.acknowledge(run.outbox))


def streamed_run(spark, sf_dir):
    """The state after the stored routes went through one run started by the stream."""
    folder = f"{shared_folder(spark)}/totelane/{uuid.uuid4().hex}"
    store = StateStore(spark, f"{folder}/store")
    import_state(store, testdata.state(spark, sf_dir), SETTINGS)
    request = spark.createDataFrame([("run", SETTINGS.as_of, sf_dir)], REQUESTS)
    request.coalesce(1).write.json(f"{folder}/requests")
    query = start_router(
        spark,
        f"{folder}/requests",
        f"{folder}/store",
        f"{folder}/runs",
        f"{folder}/progress",
        SETTINGS,
        testdata.acknowledge,
        read_extract=testdata.warehouse,
    )
    query.awaitTermination()
    return store.latest().state.select(*STATE_COLUMNS)


QUERIES: dict[str, Query] = {
    "pick_locations": pick_locations,
    "replenishments": replenishments,
    "putaways": putaways,
    "home_locations": home_locations,
    "order_destinations": order_destinations,
    "tote_destinations": tote_destinations,
    "destination_levels": destination_levels,
    "location_zone_map": location_zone_map,
    "zone_by_rule": zone_rules,
    "zone_by_rule_table": zone_by_rule_table,
    "random_zone_spread": random_zone_spread,
    "tote_zones": tote_zones,
    "tote_zones_all_states": tote_zones_all_states,
    "tote_routes": tote_routes,
    "route_rewrite": route_rewrite,
    "chute_assignment": chute_assignment,
    "preroute_report": preroute_report,
    "preroute_report_all_states": preroute_report_all_states,
    "preroute_report_putaway": preroute_report_putaway,
    "preroute_report_legacy": preroute_report_legacy,
    "taken_in_report": taken_in_report,
    "expired_routes": expired_routes,
    "pending_routes": pending_routes,
    "state_after_purge": state_after_purge,
    "stored_route_lookup": stored_route_lookup,
    "open_vs_state": open_vs_state,
    "completed_totes": completed_totes,
    "lost_completions": lost_completions,
    "rejected_rows": rejected_rows,
    "route_reconcile": route_reconcile,
    "route_reconcile_split": route_reconcile_split,
    "next_state_split": next_state_split,
    "tote_destinations_split": tote_destinations_split,
    "preroute_report_all_states_split": preroute_report_all_states_split,
    "state_inserts": state_inserts,
    "next_state": next_state,
    "dispatch_outbox": dispatch_outbox,
    "accepted_answers": accepted_answers,
    "failed_dispatches": failed_dispatches,
    "mark_routed": mark_routed,
    "run_summary": run_summary,
    "streamed_run": streamed_run,
    **streams.QUERIES,
}
