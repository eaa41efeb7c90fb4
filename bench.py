"""Headline queries, timed. Prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query is planned
anew and its whole result is computed; the best of ``BENCH_RUNS`` runs counts.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from totelane.plans.catalog import QUERIES
from totelane.session import build_session

HEADLINE = (
    "tote_zones",
    "preroute_report",
    "preroute_report_all_states",
    "tote_destinations",
    "route_reconcile",
    "state_after_purge",
    "next_state",
    "dispatch_outbox",
    "mark_routed",
    "run_summary",
)


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        spark__master=f"local[{cpus}]",
        spark__driver__memory="12g",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed(spark, HEADLINE[0], sf_dir)
    seconds = {
        name: round(min(timed(spark, name, sf_dir) for _ in range(runs)), 3) for name in HEADLINE
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
