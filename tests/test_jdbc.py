"""How reads from a database are split; no database is needed."""

from __future__ import annotations

import json

import pytest

from totelane import schemas
from totelane.sources.jdbc import Database, JdbcTable, read_table, read_warehouse, text_predicates


class Reader:
    def __init__(self):
        self.calls = []
        self.read = self

    def jdbc(self, url, table, **options):
        self.calls.append((url, table, options))


def test_numeric_bounds_become_parallel_reads():
    spark = Reader()
    table = JdbcTable("dbo.Trans", ["tran_id", "tran_type"], "tran_id", (1, 900), 8)
    read_table(spark, "jdbc:x", table, {"user": "u"}, {"tran_id": "TranID"})
    assert spark.calls == [
        (
            "jdbc:x",
            "(SELECT TranID AS tran_id, tran_type FROM dbo.Trans) src",
            {"column": "tran_id", "lowerBound": 1, "upperBound": 900, "numPartitions": 8,
             "properties": {"user": "u"}},
        )
    ]


def test_text_predicates_cover_every_value_once():
    conditions = text_predicates("k", ["B", "M'X"])
    assert conditions == [
        "k < 'B' OR k IS NULL", "k >= 'B' AND k < 'M''X'", "k >= 'M''X'",
    ]
    assert text_predicates("k", []) == []
    spark = Reader()
    read_table(spark, "jdbc:x", JdbcTable("t", ["k"], predicates=conditions), {})
    assert spark.calls[0][2]["predicates"] == conditions


def test_text_predicates_split_rows_in_spark(spark):
    rows = spark.createDataFrame([("A",), ("B",), ("C",), ("M",), ("Z",), (None,)], "k string")
    parts = [rows.filter(c).count() for c in text_predicates("k", ["B", "M"])]
    assert parts == [2, 2, 2]


def test_small_tables_are_read_in_one_query():
    spark = Reader()
    read_table(spark, "jdbc:x", JdbcTable("dbo.Zone", ["zone_id", "picking"], whole=True), {})
    assert spark.calls == [
        ("jdbc:x", "(SELECT zone_id, picking FROM dbo.Zone) src", {"properties": {}})
    ]


def test_reads_without_a_split_are_refused():
    with pytest.raises(ValueError, match="dbo.Tote"):
        read_table(Reader(), "jdbc:x", JdbcTable("dbo.Tote", ["tote_id"]), {})


def test_tables_come_from_a_file(tmp_path, monkeypatch):
    small = {"name": "dbo.T", "whole": True}
    given = {name: small for name in schemas.WAREHOUSE}
    given["trans"] = {
        "name": "dbo.Trans", "column": "tran_id", "bounds": [1, 9], "partitions": 3,
        "renames": {"tran_id": "TranID"},
    }
    given["tote_router"] = {"name": "dbo.Routes", "column": "tote_id", "edges": ["M"]}
    file = tmp_path / "tables.json"
    file.write_text(json.dumps({"url": "jdbc:x", "properties": {"user": "u"}, "tables": given}))
    database = Database.from_file(str(file))
    assert database.tables["trans"].bounds == (1, 9)
    assert len(database.tables["tote_router"].predicates) == 2
    monkeypatch.setattr("totelane.sources.jdbc.Warehouse.from_tables", dict)
    spark = Reader()
    database.warehouse(spark)
    assert len(spark.calls) == 7
    read = next(call for call in spark.calls if "dbo.Trans" in call[1])
    assert read[2]["numPartitions"] == 3 and "TranID AS tran_id" in read[1]


def test_all_tables_are_needed():
    with pytest.raises(ValueError, match="zone"):
        read_warehouse(Reader(), "jdbc:x", {}, {n: None for n in schemas.WAREHOUSE if n != "zone"})
