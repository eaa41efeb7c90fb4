"""The warehouse tables of one run, with identifiers in canonical form."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from totelane import schemas
from totelane.functions.text import clean, key
from totelane.operators.skew import together
from totelane.sources.parts import Files


_CANONICAL = {
    "tote_detail": "tote_id string, tote_key string, inventory_key string",
    "trans": (
        "tran_id bigint, inventory_key string, to_location_key string, location_key string, "
        "tran_type string"
    ),
    "trans_detail": "tran_id bigint, order_key string, location_key string",
    "orders": "order_key string, status_key string",
    "multi_home_loc": "product_key string, location_key string",
    "zone": "zone string, zone_key string, picking int",
    "zone_locations": "location_key string, zone string, zone_key string",
}

#: Rows of a file of the canonical layout.
_FILE_ROWS = 1_000_000
#: Folders of a table, one for each call that added to it.
PIECE = "_piece"


@dataclass(frozen=True)
class Warehouse:
    """One frame per table. Columns named ``*_key`` are upper-cased and trimmed once here,
    so that operators can compare, join and group on them as they are. ``kept`` has sketches
    of the keys of an extract that was taken in, see ``operators.measures``."""

    tote_detail: DataFrame
    trans: DataFrame
    trans_detail: DataFrame
    orders: DataFrame
    multi_home_loc: DataFrame
    zone: DataFrame
    zone_locations: DataFrame
    kept: Mapping[str, DataFrame] = field(default_factory=dict, compare=False)

    @classmethod
    def from_tables(cls, tables: Mapping[str, DataFrame]) -> Warehouse:
        """Canonical frames from tables as the warehouse database has them."""
        return cls(
            tote_detail=tables["tote_detail"].select(
                clean("tote_id").alias("tote_id"),
                key("tote_id").alias("tote_key"),
                key("inventory_id").alias("inventory_key"),
            ),
            trans=tables["trans"].select(
                "tran_id",
                key("tran_type").alias("tran_type"),
                key("inventory_id").alias("inventory_key"),
                key("to_location_id").alias("to_location_key"),
                key("location_id").alias("location_key"),
            ),
            trans_detail=tables["trans_detail"].select(
                "tran_id",
                key("order_id").alias("order_key"),
                key("location_id").alias("location_key"),
            ),
            orders=tables["orders"].select(
                key("order_id").alias("order_key"), key("status").alias("status_key")
            ),
            multi_home_loc=tables["multi_home_loc"].select(
                key("product_id").alias("product_key"), key("home_loc_id").alias("location_key")
            ),
            zone=tables["zone"].select(
                clean("zone_id").alias("zone"), key("zone_id").alias("zone_key"), "picking"
            ),
            zone_locations=tables["zone_locations"].select(
                key("location_id").alias("location_key"),
                clean("zone_id").alias("zone"),
                key("zone_id").alias("zone_key"),
            ),
        )

    @classmethod
    def read_extract(cls, spark: SparkSession, path: str) -> Warehouse:
        """Plain Parquet extract: one folder per table, columns as in ``schemas``."""
        return cls.from_tables(
            {
                name: spark.read.schema(schema).parquet(f"{path}/{name}")
                for name, schema in schemas.WAREHOUSE.items()
            }
        )

    def write_canonical(self, path: str, append: bool = False) -> None:
        """Store the canonical frames, in addition to those at ``path`` if ``append``."""
        self.write_piece(path, append)[2]()

    def write_piece(
        self, path: str, append: bool = False
    ) -> tuple[str, dict[str, DataFrame], Callable[[], None]]:
        """Write the canonical frames as one more piece of the tables at ``path``. They count
        from when the function returned is called, so a call that dies adds nothing. The name
        of the piece and what was written come back as well.

        ``trans`` is split by type, so that each of its roles reads only its own files."""
        spark, piece = self.tote_detail.sparkSession, uuid.uuid4().hex
        files = Files(spark, path)
        known = len(files.names("pieces"))
        if known and not append:
            raise FileExistsError(f"{path} has tables already")

        def write(name: str) -> None:
            writer = getattr(self, name).write.mode("error")
            if name == "trans":
                writer = writer.partitionBy("tran_type")
            # One row group is read by one task, however many rows it has.
            writer.option("maxRecordsPerFile", _FILE_ROWS).parquet(f"{path}/{name}/{PIECE}={piece}")

        together(spark, *(lambda name=name: write(name) for name in _CANONICAL))
        written = {
            name: spark.read.schema(columns).parquet(f"{path}/{name}/{PIECE}={piece}")
            for name, columns in _CANONICAL.items()
        }
        return piece, written, lambda: files.put_once(f"pieces/{known + 1:08d}.json", {"piece": piece})

    @classmethod
    def read_canonical(cls, spark: SparkSession, path: str) -> Warehouse:
        return cls(
            **{
                name: counted_pieces(spark.read.schema(f"{columns}, {PIECE} string"), path, name)
                for name, columns in _CANONICAL.items()
            }
        )


def counted_pieces(reader: DataFrameReader, path: str, name: str) -> DataFrame:
    """A table at ``path`` without pieces whose writer did not get to the end."""
    rows = reader.parquet(f"{path}/{name}")
    files = Files(rows.sparkSession, path)
    pieces = [files.read(f"pieces/{x}")["piece"] for x in files.names("pieces")]
    return rows.filter(F.col(PIECE).isin(*pieces)).drop(PIECE)


def open_items(warehouse: Warehouse) -> DataFrame:
    """What lies in which tote. Rows without a tote cannot be routed; they are reported as
    rejected rows instead."""
    return warehouse.tote_detail.filter(F.col("tote_key").isNotNull())


def canonical_state(state: DataFrame) -> DataFrame:
    """State rows as stored, plus the key their tote is matched on."""
    columns = schemas.TOTE_ROUTER.fieldNames()
    return state.select(*columns, key("tote_id").alias("tote_key"))


def empty_state(spark: SparkSession) -> DataFrame:
    return canonical_state(spark.createDataFrame([], schemas.TOTE_ROUTER))
