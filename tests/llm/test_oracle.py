"""Queries that SQL can express against another engine."""

from __future__ import annotations

import duckdb
import pytest

from totelane.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "pages"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    cursor = connection.execute(ORACLE[name])
    columns = [column[0] for column in cursor.description]
    expected = sorted(map(repr, cursor.fetchall()))
    found = QUERIES[name](spark, SF)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(repr(tuple(row)) for row in found.select(*columns).collect()) == expected
