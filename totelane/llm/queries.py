"""The operators applied to the supplied tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from totelane.llm import (
    ctw,
    decontamination,
    exact_dedup,
    licenses,
    manifest,
    packing,
    records,
    sharding,
    simhash,
    spelling,
    substring_dedup,
    tokens,
    toxicity,
    warc,
)
from totelane.llm.common import documents, lowered
from totelane.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = records.write_records(documents(spark, sf_dir), tokens.word_bpe(), end_id=2)
    return records.read_records(written, with_ids=False).drop("ids")


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir), 40).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir)).drop("at")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir)).drop("at", "cluster")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.toxicity(documents(spark, sf_dir), labels).drop("at")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.contamination(documents(spark, sf_dir), items).drop("at")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), tokens.word_bpe(), end_id=0)


def op8_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.scores(documents(spark, sf_dir)).drop("at")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(documents(spark, sf_dir)).drop("at")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(documents(spark, sf_dir)).drop("at")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    built = manifest.build_manifest(documents(spark, sf_dir), changed=lowered, where=tampered)
    return manifest.proof_report(built).withColumnRenamed("id", "doc_id")


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    written = warc.write_archives(pages, date="2024-01-01T00:00:00Z")
    return warc.read_archives(written, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_records": op1_token_records,
    "op2_shards": op2_shards,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_simhash": op4_simhash,
    "op5_toxicity": op5_toxicity,
    "op6_decontamination": op6_decontamination,
    "op7_packing": op7_packing,
    "op8_ctw": op8_ctw,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_licenses": op10_licenses,
    "op11_spelling": op11_spelling,
    "op12_manifest": op12_manifest,
    "op13_warc": op13_warc,
}
