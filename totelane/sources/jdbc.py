"""Partitioned reads of the warehouse tables from a relational database."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from totelane import schemas
from totelane.sources.warehouse import Warehouse, canonical_state


@dataclass(frozen=True)
class JdbcTable:
    """One remote table and how to split its read into parallel queries.

    Either ``bounds`` with a numeric ``column``, or ``predicates``: conditions that
    together cover every row once. A small table may be read in one query, but only if it
    is said to be ``whole``.
    """

    name: str
    columns: Sequence[str]
    column: str | None = None
    bounds: tuple[int, int] | None = None
    partitions: int = 1
    predicates: Sequence[str] = ()
    whole: bool = False

    def source(self, renames: Mapping[str, str] | None = None) -> str:
        """Subquery naming only the needed columns, under the names this package uses."""
        remote = renames or {}
        selected = ", ".join(
            f"{remote[name]} AS {name}" if name in remote else name for name in self.columns
        )
        return f"(SELECT {selected} FROM {self.name}) src"


def text_predicates(column: str, edges: Sequence[str]) -> list[str]:
    """Conditions that split a text column at ``edges`` and cover every row once."""
    if not edges:
        return []
    quoted = ["'" + edge.replace("'", "''") + "'" for edge in edges]
    first = f"{column} < {quoted[0]} OR {column} IS NULL"
    middle = [
        f"{column} >= {low} AND {column} < {high}"
        for low, high in zip(quoted, quoted[1:], strict=False)
    ]
    return [first, *middle, f"{column} >= {quoted[-1]}"]


def read_table(
    spark: SparkSession,
    url: str,
    table: JdbcTable,
    properties: Mapping[str, str],
    renames: Mapping[str, str] | None = None,
) -> DataFrame:
    source = table.source(renames)
    if table.predicates:
        return spark.read.jdbc(
            url, source, predicates=list(table.predicates), properties=dict(properties)
        )
    if table.bounds and table.column:
        low, high = table.bounds
        return spark.read.jdbc(
            url,
            source,
            column=table.column,
            lowerBound=low,
            upperBound=high,
            numPartitions=table.partitions,
            properties=dict(properties),
        )
    if not table.whole:
        raise ValueError(f"{table.name} has no split; say whole to read it in one query")
    return spark.read.jdbc(url, source, properties=dict(properties))


@dataclass(frozen=True)
class Database:
    """Where the tables are and how to read them."""

    url: str
    properties: Mapping[str, str]
    tables: Mapping[str, JdbcTable]
    renames: Mapping[str, Mapping[str, str]]

    @classmethod
    def from_file(cls, path: str) -> Database:
        """From JSON: ``url``, ``properties``, and ``tables`` by the names in ``schemas``, each
        with ``name`` and a split (``column``, ``bounds``, ``partitions``; ``predicates``;
        ``edges`` of a text ``column``; or ``whole``), and ``renames`` by column."""
        given = json.loads(Path(path).read_text())
        tables, renames = {}, {}
        for key, own in given["tables"].items():
            schema = {**schemas.WAREHOUSE, "tote_router": schemas.TOTE_ROUTER}[key]
            split = dict(own)
            renames[key] = split.pop("renames", {})
            if edges := split.pop("edges", None):
                split["predicates"] = text_predicates(split.pop("column"), edges)
            if "bounds" in split:
                split["bounds"] = tuple(split["bounds"])
            tables[key] = JdbcTable(columns=schema.fieldNames(), **split)
        return cls(given["url"], given.get("properties", {}), tables, renames)

    def warehouse(self, spark: SparkSession) -> Warehouse:
        return read_warehouse(spark, self.url, self.properties, self.tables, self.renames)

    def state(self, spark: SparkSession) -> DataFrame:
        table = self.tables["tote_router"]
        return read_state(spark, self.url, table, self.properties, self.renames["tote_router"])


def read_warehouse(
    spark: SparkSession,
    url: str,
    properties: Mapping[str, str],
    tables: Mapping[str, JdbcTable],
    renames: Mapping[str, Mapping[str, str]] | None = None,
) -> Warehouse:
    """All seven tables of a run; ``tables`` is keyed by the names in ``schemas.WAREHOUSE``."""
    missing = schemas.WAREHOUSE.keys() - tables.keys()
    if missing:
        raise ValueError(f"no table given for {sorted(missing)}")
    return Warehouse.from_tables(
        {
            name: read_table(spark, url, tables[name], properties, (renames or {}).get(name))
            for name in schemas.WAREHOUSE
        }
    )


def read_state(
    spark: SparkSession,
    url: str,
    table: JdbcTable,
    properties: Mapping[str, str],
    renames: Mapping[str, str] | None = None,
) -> DataFrame:
    """The stored routes of an existing state table, to be imported into a state store."""
    return canonical_state(read_table(spark, url, table, properties, renames))
