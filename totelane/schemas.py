"""Columns of the warehouse tables a run reads and of the state it keeps.

``id`` is a long, so that a run over more than 2^31 routes cannot overflow.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _table(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


TOTE_DETAIL = _table(("tote_id", T.StringType()), ("inventory_id", T.StringType()))
TRANS = _table(
    ("tran_id", T.LongType()),
    ("tran_type", T.StringType()),
    ("inventory_id", T.StringType()),
    ("to_location_id", T.StringType()),
    ("location_id", T.StringType()),
)
TRANS_DETAIL = _table(
    ("tran_id", T.LongType()), ("order_id", T.StringType()), ("location_id", T.StringType())
)
ORDERS = _table(("order_id", T.StringType()), ("status", T.StringType()))
MULTI_HOME_LOC = _table(("product_id", T.StringType()), ("home_loc_id", T.StringType()))
ZONE = _table(("zone_id", T.StringType()), ("picking", T.IntegerType()))
ZONE_LOCATIONS = _table(("location_id", T.StringType()), ("zone_id", T.StringType()))
TOTE_ROUTER = _table(
    ("id", T.LongType()),
    ("tote_id", T.StringType()),
    ("route", T.StringType()),
    ("chute", T.IntegerType()),
    ("noncon", T.IntegerType()),
    ("routed_date", T.TimestampNTZType()),
)
ACKS = _table(("id", T.LongType()), ("tote_id", T.StringType()), ("status", T.IntegerType()))

WAREHOUSE = {
    "tote_detail": TOTE_DETAIL,
    "trans": TRANS,
    "trans_detail": TRANS_DETAIL,
    "orders": ORDERS,
    "multi_home_loc": MULTI_HOME_LOC,
    "zone": ZONE,
    "zone_locations": ZONE_LOCATIONS,
}
