from __future__ import annotations

import uuid
from datetime import datetime

import pytest

from totelane import schemas
from totelane.session import build_session
from totelane.sources.warehouse import Warehouse, canonical_state

AS_OF = datetime(2014, 1, 15, 12, 0, 0)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        spark__master="local[4]",
        spark__driver__memory="4g",
        spark__sql__shuffle__partitions="4",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    def make(name: str) -> str:
        return str(tmp_path / f"{name}-{uuid.uuid4().hex[:6]}")

    return make


@pytest.fixture
def warehouse(spark):
    """A warehouse from lists of tuples; tables that are not given are empty."""

    def make(**rows) -> Warehouse:
        unknown = rows.keys() - schemas.WAREHOUSE.keys()
        assert not unknown, unknown
        return Warehouse.from_tables(
            {
                name: spark.createDataFrame(rows.get(name, []), schema)
                for name, schema in schemas.WAREHOUSE.items()
            }
        )

    return make


@pytest.fixture
def stored(spark):
    """State rows (id, tote, route, chute, noncon, routed date)."""

    def make(*rows):
        return canonical_state(spark.createDataFrame(list(rows), schemas.TOTE_ROUTER))

    return make


def as_set(df) -> set:
    rows = [tuple(row) for row in df.collect()]
    assert len(rows) == len(set(rows)), "duplicate rows"
    return set(rows)
