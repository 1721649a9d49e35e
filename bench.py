"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` is the data folder, ``BENCH_CPUS`` the number of local cores,
``BENCH_RUNS`` the number of timed runs per query (the median counts) after one
untimed run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from starflat.plans.catalog import QUERIES
from starflat.session import build_session

HEADLINE = (
    "flat_star",
    "star_view",
    "member_stats",
    "member_stats_raw",
    "card_balance",
    "population_summary",
    "spend_by_category",
    "spend_in_range",
    "orphans",
    "duplicate_rows",
    "suite_results",
    "constraint_report",
    "column_profile",
    "histogram",
    "pan_scan",
    "mask_guard",
    "synthetic_transactions",
    "csv_roundtrip",
    "parquet_pruned_read",
    "full_publish",
    "incremental_merge",
    "stream_merge",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        "starflat-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
            # Each test file is one row group, hence one scan task: joins that
            # shuffle use all cores, joins with a broadcast side stay on one.
            "spark.sql.autoBroadcastJoinThreshold": "1m",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        _execute(spark, name, folder)
        timed = [_execute(spark, name, folder) for _ in range(runs)]
        seconds[name] = round(statistics.median(timed), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


def _execute(spark, name: str, folder: str) -> float:
    started = time.monotonic()
    # The noop sink computes every row and column and stores nothing.
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.monotonic() - started


if __name__ == "__main__":
    main()
