"""Open picks: which order still has goods to fetch, and where."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from totelane.functions import fixed
from totelane.functions.locations import pick_location
from totelane.operators.skew import HotKeys, hot_keys, spread_join
from totelane.settings import SkewSettings
from totelane.sources.warehouse import Warehouse


def order_lines(warehouse: Warehouse) -> DataFrame:
    return warehouse.trans_detail.filter(F.col("order_key") > "")


def hot_transactions(warehouse: Warehouse, skew: SkewSettings) -> HotKeys:
    kept = warehouse.kept.get("lines")
    return hot_keys(order_lines(warehouse), ["tran_id"], skew, kept=kept)[0]["tran_id"]


def pick_lines(warehouse: Warehouse, hot: HotKeys) -> DataFrame:
    """Lines of pick transactions with an order: ``order_key``, ``location_key`` after the
    pick rules. Not distinct; every use collapses the rows anyway.

    A transaction only says whether a line counts, so this is a semi join, and copies of a
    transaction are collapsed where they are read.
    """
    picks = warehouse.trans.filter(F.col("tran_type") == fixed.PICK).select("tran_id").distinct()
    joined = spread_join(order_lines(warehouse), picks, "tran_id", "left_semi", hot)
    return joined.select("order_key", pick_location(F.col("location_key")).alias("location_key"))


def pick_locations(warehouse: Warehouse, hot: HotKeys) -> DataFrame:
    return pick_lines(warehouse, hot).distinct()
