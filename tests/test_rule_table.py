"""The first rule of a table of ranges, against trying all of them."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import as_set
from totelane.functions.locations import zone_by_rule
from totelane.operators.rules import RULES, _blocks, first_rules, floor_rules


def test_blocks_make_up_a_run_once(spark):
    rows = [(a, b) for a in range(1, 20) for b in range(1, 20)]
    frame = spark.createDataFrame(rows, "a bigint, b bigint")
    found = frame.select("a", "b", _blocks(F.col("a"), F.col("b"), 5).alias("blocks")).collect()
    for row in found:
        places = [x for level, k in row["blocks"] for x in range(k << level, (k + 1) << level)]
        assert sorted(places) == list(range(row["a"], row["b"] + 1))
        assert len(row["blocks"]) <= 10


@pytest.mark.parametrize("seed", range(4))
def test_overlapping_ranges(spark, seed):
    dice = random.Random(seed)

    def code():
        return "".join(dice.choices("ABé1", k=dice.randint(0, 4)))

    rules = [(code(), code(), dice.choice("xyz"), dice.randint(0, 40)) for _ in range(300)]
    rules += [(None, "B", "n", 0), ("A", None, "n", 0)]
    codes = [code() for _ in range(80)] + [None]
    found = first_rules(spark.createDataFrame([(x,) for x in codes], "code string"),
                        spark.createDataFrame(rules, RULES))
    named = [r for r in rules if r[0] is not None and r[1] is not None]

    def first(one):
        held = [(r[3], r[2]) for r in named if r[0].encode() <= one.encode() <= r[1].encode()]
        return min(held)[1] if held else None

    assert as_set(found) == {(one, first(one)) for one in codes if one is not None}


def test_fixed_rules_as_a_table(spark):
    letters = "AGHXZ"
    codes = [f"1{a}{b}" for a in "TUVWXY" for b in "ABCFGHXZ"] + [f"2{a}" for a in letters]
    frame = spark.createDataFrame([(x,) for x in codes], "code string")
    by_rule = frame.select("code", zone_by_rule(F.col("code")).alias("zone"))
    assert as_set(first_rules(frame, floor_rules(spark))) == as_set(by_rule)


def test_no_rules_and_no_codes(spark):
    frame, none = spark.createDataFrame([("A",)], "code string"), floor_rules(spark).limit(0)
    assert as_set(first_rules(frame, none)) == {("A", None)}
    assert first_rules(frame.limit(0), floor_rules(spark)).isEmpty()
