"""Runs started by a stream of run requests.

A request is one small row that names a warehouse extract and the run's time. The stream
carries only the requests; each run reads its extract as an ordinary, partitioned batch.
State passes from run to run through the snapshots of the state store, so a query that is
restarted, or a batch that is repeated, goes on where the last committed run ended.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from totelane.plans.run import Deliver, RunResult, run_once
from totelane.settings import RouterSettings
from totelane.sources.state_store import StateStore
from totelane.sources.warehouse import Warehouse

REQUESTS = "run_id string, as_of timestamp_ntz, extract string"

ReadExtract = Callable[[SparkSession, str], Warehouse]


def run_requests(
    requests: DataFrame,
    store_root: str,
    folder: str,
    settings: RouterSettings,
    deliver: Deliver,
    read_extract: ReadExtract = Warehouse.read_extract,
) -> list[RunResult]:
    """The runs of one batch of requests, one after the other, in order of their time."""
    spark = requests.sparkSession
    store = StateStore(spark, store_root)
    return [
        run_once(
            read_extract(spark, request["extract"]),
            store,
            replace(settings, as_of=request["as_of"]),
            request["run_id"],
            folder,
            deliver,
        )
        for request in requests.orderBy("as_of", "run_id").toLocalIterator()
    ]


def start_router(
    spark: SparkSession,
    requests_folder: str,
    store_root: str,
    folder: str,
    checkpoint: str,
    settings: RouterSettings,
    deliver: Deliver,
    read_extract: ReadExtract = Warehouse.read_extract,
    every: str | None = None,
) -> StreamingQuery:
    """Follow ``requests_folder`` (JSON lines, one file per request or more).

    ``every`` is the trigger interval, such as ``"2 minutes"``; without it the query works
    off what is there and ends.
    """
    requests = (
        spark.readStream.schema(REQUESTS).option("maxFilesPerTrigger", 1).json(requests_folder)
    )

    def run_batch(batch: DataFrame, _batch_id: int) -> None:
        run_requests(batch, store_root, folder, settings, deliver, read_extract)

    writer = requests.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()
