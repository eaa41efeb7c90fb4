"""Column rules, with expected values worked out by hand from the rules' description."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from totelane.functions import fixed
from totelane.functions.locations import (
    order_destination,
    pick_location,
    spread_zone,
    zone_by_rule,
)
from totelane.functions.routes import (
    completion_chute,
    message,
    rewrite_route,
    route_chute,
    route_noncon,
)
from totelane.functions.text import clean, key, same_text


def apply(spark, rule, values, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(rule(F.col("v"))).collect()]


def test_key_ignores_case_and_outer_blanks(spark):
    values = ["t1", " T1 ", "\tT1\x01\n", "a b", "", "  ", None]
    assert apply(spark, key, values) == ["T1", "T1", "T1", "A B", "", "", None]
    assert apply(spark, clean, [" t1\x00 "]) == ["t1"]


PICK_LOCATIONS = [
    ("WW-01", "NC"),
    ("XX1", "NC"),
    ("YY-02", "NC"),
    ("ZZ", "NC"),
    ("1UA-07", "1UA-07"),
    ("1XG-99", "1XG-99"),
    ("1XH-01", "NC"),  # past the kept codes; as text '1X' lies between '00' and '99'
    ("1TZ-01", "NC"),
    ("10-10", "NC"),
    ("00-10", "NC"),
    ("99-10", "NC"),
    ("9A-01", "9A-01"),  # as text '9A' lies past '99'
    ("5", "NC"),  # one digit sorts between '00' and '99'
    ("MZ-05", "MZ-05"),
    ("", ""),
    (None, None),
]


def test_pick_location(spark):
    given = [g for g, _ in PICK_LOCATIONS]
    assert apply(spark, pick_location, given) == [w for _, w in PICK_LOCATIONS]


ZONES = [
    ("PACKING", "Packing"),
    ("PACKING2", None),
    ("1UA-01", "FB"),
    ("1VA-01", "FB"),
    ("1VB-01", "FD"),
    ("1VF-01", "FD"),
    ("1VG-01", "HB"),
    ("1WB-01", "HB"),
    ("1WC-01", "HD"),
    ("1WG-01", "HD"),
    ("1WH-01", "JB"),
    ("1XB-01", "JB"),
    ("1XC-01", "JD"),
    ("1XG-01", "JD"),
    ("1XH-01", None),
    ("1TZ-01", None),
    ("1V", "FB"),
    ("RANDOM", None),
    ("NC", None),
    (None, None),
]


def test_zone_by_rule(spark):
    assert apply(spark, zone_by_rule, [g for g, _ in ZONES]) == [w for _, w in ZONES]


def test_order_destination(spark):
    given = ["PICKED", "OPEN", "", None]
    assert apply(spark, order_destination, given) == ["PACKING", "NC", "NC", None]


def test_spread_is_stable_and_covers_every_zone(spark):
    totes = [f"T{i}" for i in range(2000)]
    first = apply(spark, spread_zone, totes)
    assert first == apply(spark, spread_zone, totes)
    assert set(first) == set(fixed.SPREAD_ZONES)
    assert len(fixed.SPREAD_ZONES) == len(set(fixed.SPREAD_ZONES)) == 27


def test_legacy_spread_reaches_six_zones_in_their_shares(spark):
    totes = [f"T{i}" for i in range(5000)]
    drawn = apply(spark, lambda c: spread_zone(c, "legacy"), totes)
    shares = {zone: drawn.count(zone) / len(drawn) for zone in set(drawn)}
    expected = {"AD": 0.3, "AF": 0.3, "CB": 0.1, "FA": 0.1, "GH": 0.1, "IF": 0.1}
    assert shares.keys() == expected.keys()
    assert all(abs(shares[z] - expected[z]) < 0.03 for z in expected)


ROUTES = [
    ("FB-HB", "FB-HB", 0, 3),
    ("NC", "-", 4, 4),
    ("FB-NC", "FB--", 4, 3),
    ("FB-HD-NC", "FB-HD--", 4, 3),
    ("FB-NC-HD", "FB---HD", 4, 3),
    ("DB-Hospital", "-", 4, 4),
    ("FB-Packing", "-", 0, 4),
    ("NC-Packing", "-", 4, 4),
    ("Packing", "-", 0, 4),
    ("ANC", "A-", 4, 3),  # the mark is found inside other zone names too
    ("NC-NC", "---", 4, 3),
    ("nc", "nc", 0, 3),
    ("packing", "packing", 0, 3),
]


@pytest.mark.parametrize("column", ["route", "noncon", "chute"])
def test_routes(spark, column):
    rule = {
        "route": rewrite_route,
        "noncon": route_noncon,
        "chute": lambda c: route_chute(rewrite_route(c)),
    }[column]
    place = {"route": 1, "noncon": 2, "chute": 3}[column]
    assert apply(spark, rule, [r[0] for r in ROUTES]) == [r[place] for r in ROUTES]


def test_completion_chute(spark):
    assert apply(spark, completion_chute, [4, 0, 3, None], "int") == [4, 1, 1, 1]


def test_same_text_ignores_case_only(spark):
    df = spark.createDataFrame([("hb", "HB"), ("hb ", "HB")], "a string, b string")
    assert [r[0] for r in df.select(same_text(F.col("a"), F.col("b"))).collect()] == [True, False]


def test_message_escapes(spark):
    df = spark.createDataFrame([('T"1', "FB-HB", 3)], "tote string, path string, chute int")
    text = df.select(message(F.col("tote"), F.col("path"), F.col("chute"))).first()[0]
    assert text == '{"tote":"T\\"1","path":"FB-HB","chute":3}'
