from __future__ import annotations

import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from totelane.operators.numbering import number_rows
from totelane.session import durable, shared_folder


def test_numbers_follow_the_order_over_partitions(spark):
    keys = [f"T{n}" for n in range(5000)]
    random.Random(1).shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(7)
    numbered = number_rows(df, [F.col("k").asc()], "n")
    found = {row["k"]: row["n"] for row in numbered.collect()}
    assert found == {key: place for place, key in enumerate(sorted(keys), 1)}
    assert numbered.columns == ["k", "n"]


def test_several_columns_and_nulls_first(spark):
    df = spark.createDataFrame([(None, "b"), (2, "x"), (None, "a"), (1, "z")], "id int, k string")
    order = [F.col("id").asc_nulls_first(), F.col("k").asc()]
    rows = number_rows(df, order, "n").orderBy("n").collect()
    assert [(r["id"], r["k"], r["n"]) for r in rows] == [
        (None, "a", 1), (None, "b", 2), (1, "z", 3), (2, "x", 4),
    ]


def test_no_rows(spark):
    empty = spark.createDataFrame([], "k string")
    assert number_rows(empty, [F.col("k").asc()], "n").count() == 0


def test_durable_rows_do_not_change(spark, folder):
    path = folder("table")
    kept = durable(spark.range(1000).withColumn("r", F.rand()), path)
    assert kept.agg(F.sum("r")).first()[0] == kept.agg(F.sum("r")).first()[0]
    assert spark.read.parquet(path).count() == 1000
    with pytest.raises(Exception, match="(?i)exist"):
        durable(spark.range(1), path)


def session(named, master, own=None):
    conf = SimpleNamespace(get=lambda name, default=None: named or default)
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: context.folder,
        setCheckpointDir=lambda folder: setattr(context, "folder", folder),
        folder=own,
    )
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_shared_folder_is_the_one_the_session_names():
    assert shared_folder(session("hdfs://a/b/", "yarn")) == "hdfs://a/b"
    assert shared_folder(session(None, "yarn", "hdfs://c")) == "hdfs://c"


def test_only_a_local_session_may_choose_a_folder():
    with pytest.raises(RuntimeError):
        shared_folder(session(None, "yarn"))
    assert shared_folder(session(None, "local[2]"))
