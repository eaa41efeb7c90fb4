"""From raw documents to packed training sequences, in five stages.

Toxic documents go, then exact duplicates, then all but one document of each group of near
duplicates, then documents that hold benchmark passages; the rest is packed. Each stage gets
what its predecessor kept, written and read again, and returns the columns of ``documents``,
the last one the pieces of the sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from totelane.llm import decontamination, exact_dedup, packing, simhash, tokens, toxicity
from totelane.llm.common import documents, placed, rows_without
from totelane.session import durable


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = placed(docs)
    found = exact_dedup.exact_duplicates(docs)
    return rows_without(docs, durable(found.filter("NOT kept").select("at")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = placed(docs)
    found = durable(simhash.near_duplicates(docs).select("at", "doc_id", "cluster"))
    dropped = found.select("at").join(simhash.first_of_each(found), "at", "left_anti")
    return rows_without(docs, durable(dropped))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs, items = placed(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.contamination(docs, items)
    return rows_without(docs, durable(found.filter("contaminated").select("at")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokens.word_bpe(), end_id=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

# Token ids and a fitted classifier are beyond SQL; tests/llm compares with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
