"""Every registered query against its SQL counterpart, and the plans behind them."""

from __future__ import annotations

import os
import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_point
from totelane.plans.catalog import QUERIES
from totelane.plans.oracle import ORACLE
from totelane.plans.streams import QUERIES as STREAMS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF}/{file}'")
    yield connection
    connection.close()


def test_every_query_has_a_counterpart():
    assert QUERIES.keys() == ORACLE.keys()
    assert entry_point.queries().items() >= QUERIES.items()
    assert entry_point.oracle_sql().items() >= ORACLE.items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    found = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLE[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(found.columns) == sorted(columns)
    expected = sorted(map(repr, (tuple(row) for row in cursor.fetchall())))
    assert sorted(repr(tuple(row)) for row in found.select(*columns).collect()) == expected
    assert expected


def test_entry(spark):
    assert entry_point.entry(spark).columns == [
        "tote_key", "tote_id", "origroute", "route", "chute", "noncon",
    ]


def plan_of(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


# Results of streams are read from files; the plans are those of the streams themselves.
@pytest.mark.parametrize("name", [name for name in QUERIES if name not in STREAMS])
def test_plans_stay_distributed(spark, name):
    """No cross or nested-loop join, no Python in the tasks, no window over everything."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES[name](spark, SF), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for operator in (
        "NestedLoop", "Cartesian", "EvalPython", "InPandas", "Window", "Exchange SinglePartition",
    ):
        assert operator not in plan, operator


def test_views_read_every_row():
    from totelane.sources.testdata import view_texts

    assert not [name for name, text in view_texts().items() if " WHERE " in text.upper()]


def test_only_the_columns_used_are_read(spark):
    plan = plan_of(QUERIES["pick_locations"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert sorted(schemas) == [
        "l_orderkey:bigint,l_partkey:bigint,l_linestatus:string", "o_orderkey:bigint",
    ]


def test_expiry_reaches_the_scan(spark, folder):
    from totelane.operators.state import expired_routes
    from totelane.sources import testdata
    from totelane.sources.warehouse import canonical_state

    path = folder("state")
    testdata.state_table(spark, SF).write.parquet(path)
    plan = plan_of(expired_routes(canonical_state(spark.read.parquet(path)), testdata.AS_OF))
    assert "LessThan(routed_date,2014-01-15T11:00)" in plan


def test_orders_are_joined_without_another_shuffle(spark, folder):
    """Picks are summed up by order and stay partitioned by it for the join with totes."""
    from totelane.plans.run import RoutingRun
    from totelane.settings import RouterSettings
    from totelane.sources import testdata
    from totelane.sources.warehouse import Warehouse

    path = folder("canonical")
    testdata.warehouse(spark, SF).write_canonical(path)
    wh = Warehouse.read_canonical(spark, path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        run = RoutingRun(wh, testdata.state(spark, SF), RouterSettings(testdata.AS_OF))
        plan = plan_of(run.reconciled, "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # Lines 1, picks 1, orders 1, items 1, totes 1, state 1; the zone map is written before.
    assert len(shuffles) == 6, plan
    # Pieces of the extract are partitions as well.
    assert re.search(r"PartitionFilters: \[[^\]]*isnotnull\(tran_type#\d+\)", plan)


def test_lines_of_no_pick_are_dropped_before_they_are_shuffled(spark):
    """A filter of bits over the pick transactions, where the lines are many."""
    size = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    settings = {size: "0", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    want = Counter(map(tuple, QUERIES["pick_locations"](spark, SF).collect()))
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        found = QUERIES["pick_locations"](spark, SF)
        plan = plan_of(found, "simple")
        assert Counter(map(tuple, found.collect())) == want
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    lines = [x for x in plan.splitlines() if "might_contain" in x]
    assert lines and "bloom_filter_agg" in plan
