"""Benchmark: the headline queries at one scale, as one JSON line.

Every query runs once to warm up and then twice; the better of the two counts.
Reading, deriving the log, planning and all shuffles are inside the timing;
results go to Spark's no-op sink, so no row passes the driver.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "orders_flat_final",
    "transactions_final",
    "merge_two_batches",
    "line_items_final",
    "disposition_counts",
    "coerced_types",
    "dlq_records",
    "replay_plan",
    "drift_fields",
    "stage_latencies",
    "kpi_summary",
    "latency_last_100",
    "recent_20",
    "lag_rollup",
    "queue_status",
    "count_parity",
    "update_propagated",
    "delete_propagated",
    "duplicate_keys",
)


def seconds(run) -> float:
    started = time.perf_counter()
    run()
    return time.perf_counter() - started


def main() -> None:
    from tidelog.plans.catalog import all_queries
    from tidelog.session import local_session
    from tidelog.sources import fixtures
    from tidelog.sources.changes import read_from_files, stream_from_files
    from tidelog.sinks.batches import Batch
    from tidelog.streaming.pipeline import Store, process_batch

    spark = local_session(CPUS, "bench", memory=os.environ.get("BENCH_MEMORY", "16g"))
    queries = all_queries()

    def drain(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    timings = {}
    for name in HEADLINE:
        run = lambda: drain(queries[name](spark, SF_DIR))
        run()
        timings[name] = round(min(seconds(run), seconds(run)), 3)

    # The whole write path of one micro-batch holding the complete log, and of a small one.
    root = tempfile.mkdtemp(prefix="bench-")
    fixtures.order_log(spark, SF_DIR, partitions=int(CPUS)).write.parquet(f"{root}/log")
    records = read_from_files(spark, f"{root}/log")
    n = records.count()
    store = Store(spark, f"{root}/store", buckets=8).create()
    process_batch(records, store, Batch("bench", 0))
    timings["micro_batch_whole_log"] = round(seconds(lambda: process_batch(records, store, Batch("bench", 1))), 3)
    small = records.filter("offset < 800")
    process_batch(small, store, Batch("bench", 2))
    timings["micro_batch_small"] = round(seconds(lambda: process_batch(small, store, Batch("bench", 3))), 3)

    flagship = timings["orders_flat_final"]
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "log_records": n,
                "flagship_events_per_min": round(n / flagship * 60),
                "write_path_events_per_min": round(n / timings["micro_batch_whole_log"] * 60),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
