from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import as_set
from totelane.operators.skew import Lookup, fits_broadcast, hot_keys, sketches, spread_join, together
from totelane.settings import SkewSettings

SMALL = SkewSettings(min_rows=10)


def counted(df):
    rows = {}
    for row in df.collect():
        rows[tuple(row)] = rows.get(tuple(row), 0) + 1
    return rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows has one key, a tenth has none, copies included."""
    rng = random.Random(3)
    rows = []
    for n in range(900):
        key = "hot" if n % 3 == 0 else None if n % 10 == 1 else f"k{rng.randrange(300)}"
        rows.append((key, n // 6))
    left = spark.createDataFrame(rows, "k string, n int").repartition(4)
    right = spark.createDataFrame(
        [("hot", 1), ("k1", 2), ("k2", 3), ("k2", 4), ("x", 5), (None, 6)], "k string, r int"
    )
    return left, right


def test_hot_keys_and_blanks_are_found(skewed):
    hot, found = hot_keys(skewed[0], ["k", "n"], SMALL, greatest="n")
    splits = dict(hot["k"])
    assert splits["hot"] == 6  # 300 of 900 rows, 225 per partition, in four pieces each
    assert hot["n"] == []
    assert found["_greatest"] == 149


def test_what_one_task_merges_does_not_grow_with_the_scan(spark, monkeypatch):
    """Few sketches reach each task of the second level and of the last, however many scan
    partitions there are."""
    monkeypatch.setattr("totelane.operators.skew._GROUPS", 8)
    monkeypatch.setattr("totelane.operators.skew._LAST_GROUPS", 4)
    for partitions in (2, 8, 40):
        rows = spark.range(4000, numPartitions=partitions).select((F.col("id") % 7).alias("k"))
        parts = sketches(rows, ["k"], 100)
        assert parts.count() == min(partitions, 4)
        hot, found = hot_keys(rows, ["k"], SMALL)
        assert found["_rows"] == 4000 and hot["k"] == []
    one = spark.range(4000, numPartitions=40).select(F.lit("a").alias("k"))
    assert [key for key, _ in hot_keys(one, ["k"], SMALL)[0]["k"]] == ["a"]


def test_no_rows_no_hot_keys(spark):
    hot, _ = hot_keys(spark.createDataFrame([], "k string"), ["k"], SkewSettings(min_rows=0))
    assert hot == {"k": []}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot", [[("hot", 7)], [("hot", 3), (None, 5), ("k2", 2), ("absent", 4)]])
def test_split_join_equals_plain_join(skewed, how, hot):
    left, right = skewed
    split = spread_join(left, right, "k", how, hot)
    plain = left.join(right, "k", how)
    assert split.columns == plain.columns
    assert counted(split) == counted(plain)


def test_split_join_on_two_columns(skewed, spark):
    left = skewed[0].withColumn("m", F.col("n") % 3)
    right = spark.createDataFrame([("hot", 0, "a"), ("hot", 1, "b"), ("k1", 2, "c")], "k string, m int, v string")
    split = spread_join(left, right, ["k", "m"], "inner", [("hot", 4)])
    assert counted(split.select("k", "m", "n", "v")) == counted(
        left.join(right, ["k", "m"]).select("k", "m", "n", "v")
    )


def test_hot_key_reaches_several_tasks(spark):
    """Copies of one row, too, are spread: they differ in the partition they come from."""
    left = spark.range(8000, numPartitions=8).select(F.lit("hot").alias("k"), F.lit(1).alias("n"))
    right = spark.createDataFrame([("hot", 2)], "k string, r int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for hot, most in ([], 8000), ([("hot", 40)], 4000):
            joined = spread_join(left, right, "k", "inner", hot)
            tasks = joined.groupBy(F.spark_partition_id()).count().collect()
            assert sum(task["count"] for task in tasks) == 8000
            assert max(task["count"] for task in tasks) <= most
            assert (len(tasks) > 1) == bool(hot)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_other_joins_are_refused(skewed):
    with pytest.raises(ValueError):
        spread_join(*skewed, "k", "full_outer", [("hot", 2)])


def test_broadcast_bound_counts_rows_and_bytes(spark):
    table = spark.createDataFrame([(f"key{n}", "v" * 10) for n in range(20)], "k string, v string")
    assert fits_broadcast(table, SkewSettings(broadcast_rows=20))
    assert not fits_broadcast(table, SkewSettings(broadcast_rows=19))
    assert not fits_broadcast(table, SkewSettings(broadcast_bytes=100))
    assert fits_broadcast(table.limit(0), SkewSettings(broadcast_rows=0))


def test_lookup_is_the_same_shuffled_or_broadcast(skewed, spark):
    table = spark.createDataFrame([("hot", "a"), ("k1", "b")], "k string, v string")
    small = Lookup(table, "k", SkewSettings())
    large = Lookup(table, "k", SkewSettings(min_rows=0, broadcast_rows=0))
    assert small.small and not large.small
    assert counted(small.add_to(skewed[0])) == counted(large.add_to(skewed[0]))


def test_together_returns_results_in_order(spark):
    assert together(spark, lambda: spark.range(3).count(), lambda: spark.range(5).count()) == [3, 5]


def test_together_passes_errors_on(spark):
    with pytest.raises(ZeroDivisionError):
        together(spark, lambda: 1 // 0, lambda: 1)


def test_as_set_refuses_duplicates(spark):
    with pytest.raises(AssertionError):
        as_set(spark.createDataFrame([(1,), (1,)], "n int"))
