"""Spark session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def build_session(app_name: str = "totelane", **conf: str) -> SparkSession:
    """A session with the settings the plans are written for; ``conf`` overrides."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        # Rows that a join will drop are dropped before they are shuffled, by a filter of bits
        # over the other side's keys, where the rows are many and those keys come from a filter.
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1g",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
        "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "100000000",
        "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "1073741824",
        **{name.replace("__", "."): value for name, value in conf.items()},
    }
    builder = SparkSession.builder.appName(app_name)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder; a cluster must name one,
    because its executors cannot read another machine's disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="totelane-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def durable(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    Later stages then read files, so a lost executor costs a re-read and not the whole
    upstream plan, and every use sees the same rows.
    """
    spark = df.sparkSession
    target = path or f"{shared_folder(spark)}/totelane/{uuid.uuid4().hex}"
    df.write.mode("error").parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def durable_counted(
    df: DataFrame, path: str | None, *counts: Column
) -> tuple[DataFrame, dict[str, int]]:
    """``durable``, and aggregates of the rows that are taken while they are written. They sit
    right below the write, where a task that is run again counts once."""
    observed = Observation(uuid.uuid4().hex)
    written = durable(df.observe(observed, *counts), path)
    return written, observed.get
