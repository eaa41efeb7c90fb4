"""The warehouse tables modelled as views over the supplied Parquet tables.

Each view reads its whole table; conditions on keys only decide what a row stands for. The
view texts run unchanged in Spark SQL and in the engine that checks the results.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from totelane.sources.warehouse import Warehouse, canonical_state

AS_OF = datetime(2014, 1, 15, 12, 0, 0)

# Only the columns the views use; a given schema saves a job per table to find it out.
_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_linestatus string",
    "part": "p_partkey bigint",
    "nation": "n_nationkey int, n_regionkey int",
}


def _digits(number: str, modulus: int) -> str:
    return f"lpad(CAST({number} % {modulus} AS STRING), 2, '0')"


def _location(number: str) -> str:
    """Location code derived from a number; every rule of the router is reached."""
    aisle = (
        f"concat('1', chr(CAST(85 + {number} % 4 AS INT)), "
        f"chr(CAST(65 + ({number} * 7) % 26 AS INT)), '-', {_digits(number, 97)})"
    )
    return f"""CASE
        WHEN {number} % 20 < 8 AND {number} % 3 = 0 THEN lower({aisle})
        WHEN {number} % 20 < 8 THEN {aisle}
        WHEN {number} % 20 = 8 THEN 'WW-01'
        WHEN {number} % 20 = 9 THEN 'yy-02'
        WHEN {number} % 20 = 10 THEN concat({_digits(number, 89)}, '-10')
        WHEN {number} % 20 = 11 THEN '9A-01'
        WHEN {number} % 20 < 17 THEN concat('MZ-', {_digits(number, 50)})
        WHEN {number} % 20 = 17 THEN 'RANDOM'
        WHEN {number} % 100 = 18 THEN 'Packing'
        WHEN {number} % 20 = 18 THEN '9B-01'
        WHEN {number} % 100 = 19 THEN NULL
        WHEN {number} % 100 = 39 THEN 'HOSP-01'
        ELSE 'MZ-77' END"""


def _zone(number: str) -> str:
    return f"""CASE WHEN {number} = 20 THEN 'Hospital'
        ELSE concat(chr(CAST(65 + floor({number} / 5) AS INT)),
            chr(CAST(65 + {number} % 5 AS INT))) END"""


def _text(prefix: str, column: str) -> str:
    return f"concat('{prefix}', CAST({column} AS STRING))"


def _moment(timestamp_type: str) -> str:
    return f"{timestamp_type} '{AS_OF.isoformat(sep=' ')}'"


def view_texts(timestamp_type: str = "TIMESTAMP_NTZ") -> dict[str, str]:
    """SELECT text per warehouse table."""
    return {
        "trans": f"""SELECT o_orderkey AS tran_id,
            CASE WHEN o_orderkey % 10 < 6 THEN 'pick' WHEN o_orderkey % 10 = 6 THEN 'PICK'
                WHEN o_orderkey % 10 = 7 THEN 'repl' ELSE 'putaway' END AS tran_type,
            CASE WHEN o_orderkey % 10 = 9 THEN {_text('O', 'o_orderkey')}
                ELSE {_text('T', 'o_orderkey')} END AS inventory_id,
            {_location('o_custkey')} AS to_location_id,
            {_location('(o_custkey + 1)')} AS location_id
            FROM orders""",
        "trans_detail": f"""SELECT l_orderkey AS tran_id,
            CASE WHEN l_linestatus = 'O' AND l_orderkey % 50 <> 44 THEN {_text('O', 'l_orderkey')}
                ELSE '' END AS order_id,
            {_location('l_partkey')} AS location_id
            FROM lineitem""",
        "tote_detail": f"""SELECT DISTINCT
            CASE WHEN l_orderkey % 997 = 5 THEN NULL
                WHEN l_orderkey % 997 = 6 THEN 'T'
                WHEN l_orderkey % 10 = 1 THEN {_text('T', '(l_orderkey - 1)')}
                WHEN l_orderkey % 11 = 0 THEN concat({_text('t', 'l_orderkey')}, ' ')
                ELSE {_text('T', 'l_orderkey')} END AS tote_id,
            CASE WHEN l_orderkey % 10 = 8 AND l_linenumber = 1 THEN {_text('P', 'l_partkey')}
                ELSE {_text('O', 'l_orderkey')} END AS inventory_id
            FROM lineitem""",
        "wh_orders": f"""SELECT {_text('O', 'o_orderkey')} AS order_id,
            CASE o_orderstatus WHEN 'F' THEN 'picked' WHEN 'O' THEN 'open' END AS status
            FROM orders""",
        "multi_home_loc": f"""SELECT {_text('P', 'p_partkey')} AS product_id,
            CASE WHEN p_partkey % 2 = 0 THEN {_location('(p_partkey + 3)')} END AS home_loc_id
            FROM part""",
        "zone": f"""SELECT {_zone('n_nationkey')} AS zone_id,
            CASE WHEN n_regionkey = 4 THEN 0 ELSE 1 END AS picking
            FROM nation""",
        "zone_locations": f"""SELECT {_location('p_partkey')} AS location_id,
            CASE WHEN p_partkey % 100 = 39 THEN 'Hospital'
                WHEN p_partkey % 20 NOT BETWEEN 12 AND 16 THEN '??'
                WHEN p_partkey % 60 < 20 THEN lower({_zone('(p_partkey % 20)')})
                ELSE {_zone('(p_partkey % 20)')} END AS zone_id
            FROM part""",
        "tote_router": f"""SELECT o_orderkey + 1 AS id,
            CASE WHEN o_orderkey % 97 = 13 THEN NULL
                WHEN o_orderkey % 10 <> 1 AND o_orderkey % 3 <> 0 THEN {_text('T', 'o_orderkey')}
                ELSE {_text('X', 'o_orderkey')} END AS tote_id,
            CASE o_orderkey % 4 WHEN 0 THEN '-' WHEN 1 THEN 'FB' WHEN 2 THEN 'hb' END AS route,
            3 AS chute,
            CASE WHEN o_orderkey % 5 = 0 THEN 4 ELSE 0 END AS noncon,
            CASE WHEN o_orderstatus <> 'P' THEN {_moment(timestamp_type)}
                - INTERVAL '1' MINUTE * CAST(o_orderkey % 121 AS INT) END AS routed_date
            FROM orders""",
    }


def _view(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """The SELECT over the one supplied table that it names after its last FROM."""
    name = text.rsplit("FROM ", 1)[1].split()[0]
    table = spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")
    return spark.sql(text.replace(f"FROM {name}", "FROM {table}"), table=table)


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The seven tables in the form the warehouse database would give them."""
    texts = view_texts()
    texts["orders"] = texts.pop("wh_orders")
    del texts["tote_router"]
    return {name: _view(spark, sf_dir, text) for name, text in texts.items()}


def state_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored routes at the start of the run."""
    return _view(spark, sf_dir, view_texts()["tote_router"])


def acknowledge(outbox: DataFrame) -> DataFrame:
    """The conveyor's answers: every seventh message fails, the others are accepted, but each
    eleventh stays without answer. Each thirteenth is answered twice."""
    place = F.col("seq")
    answers = outbox.filter(place % 11 != 0).select(
        "id", "tote_id", F.when(place % 7 == 0, 500).otherwise(201).alias("status"), "seq"
    )
    return answers.unionByName(answers.filter(place % 13 == 0)).drop("seq")


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse.from_tables(tables(spark, sf_dir))


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_state(state_table(spark, sf_dir))
