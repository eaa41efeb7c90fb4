"""Operator 3: exact duplicates by distributed radix partitioning from the first byte on.

The bytes that documents are split by are the length of the normalised text and then the
text itself. A round splits every group by its next run of bytes, longer from round to
round; rows alone in their group are done, and so are groups whose text has ended, whose
members are equal byte for byte. No digest decides on equality: hashes only spread hot
groups over tasks.

White space runs count as one blank, a null text as the empty one. The row of the smallest
doc_id stays, of repeated ids the first in the scan; null ids come after all others. Empty
tables give empty results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from totelane.llm.common import SPACES, hot_groups, meet, written_entries
from totelane.session import durable

#: Bytes of the first run, and the factor from each run to the next.
FIRST_RUN = 64
GROWTH = 64


def normalised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    rows = written_entries(docs, id_col, text_col)
    return rows.withColumn("text", F.regexp_replace("text", SPACES, " "))


def _split(rows: DataFrame, by: list[str], run: int) -> DataFrame:
    """The rows of groups that still have several members, with their new group, its size
    and first member, less the bytes looked at. Groups are named by their first member."""
    cut = rows.select("at", "doc_id", "rest", *by, F.substring("rest", 1, run).alias("run"))
    cut = cut.withColumn("spread", F.xxhash64(*by, "run"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "at"))
    groups = durable(
        cut.groupBy("spread", *by, "run")
        .agg(F.count(F.lit(1)).alias("n"), first.alias("first"))
        .filter("n > 1")
    )
    hot = hot_groups(groups, "spread")
    joined = meet(cut, groups, ["spread", *by, "run"], "inner", hot)
    return durable(
        joined.select(
            "at",
            "doc_id",
            F.col("first.at").alias("member"),
            F.col("first.doc_id").alias("keep_id"),
            "n",
            F.expr(f"substring(rest, {run + 1})").alias("rest"),
        )
    )


def duplicate_rows(rows: DataFrame) -> DataFrame:
    """``at``, ``keep_id``, ``keep_at`` and ``group_size`` of the rows of ``at``, ``doc_id``,
    ``text`` whose text occurs more than once."""
    texts = rows.select("at", "doc_id", F.encode("text", "UTF-8").alias("rest")).withColumn(
        "bytes", F.octet_length("rest")
    )
    run, found, ended = FIRST_RUN, [], F.octet_length("rest") == 0
    left = _split(texts, ["bytes"], run)
    while True:
        found.append(left.filter(ended))
        going = left.filter(~ended)
        if going.isEmpty():
            break
        run *= GROWTH
        left = _split(going, ["member"], run)
    return reduce(DataFrame.unionByName, found).select(
        "at", "keep_id", F.col("member").alias("keep_at"), F.col("n").alias("group_size")
    )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``at``, ``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` of each row."""
    rows = normalised(docs, id_col, text_col)
    named = rows.select("at", "doc_id", F.sha2("text", 256).alias("text_sha256"))
    alone = F.col("keep_at").isNull()
    return meet(named, duplicate_rows(rows), "at", "left").select(
        "at",
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("keep_at") == F.col("at"))).alias("kept"),
        "text_sha256",
    )
