"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query runs once to warm up, then five timed runs; the median is
reported.  Every run executes the whole plan from the parquet tables into
Spark's ``noop`` sink, so driver transfer does not blur the engine time.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from perkspark.plans.registry import QUERIES  # noqa: E402
from perkspark.session import build_session  # noqa: E402

HEADLINE = [
    "events_parsed",
    "offer_interactions",
    "channel_effectiveness",
    "channel_revenue",
    "age_distribution",
    "offer_completion_metrics",
    "v_channel_performance",
    "v_age_summary",
    "v_offer_summary",
    "layer_audit",
    "tpch_segment_conditional_sums",
    "tpch_orders_in_customer_interval",
    "tpch_lines_sum_distinct",
    "tpch_median_price_by_brand",
    "tpch_priority_pivot",
    "tpch_share_and_rank",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = sys.argv[1:] or HEADLINE
    warehouse = tempfile.mkdtemp(prefix="perkspark-bench-warehouse-")
    spark = build_session(
        f"local[{cpus}]",
        shuffle_partitions=max(8, 2 * cpus),
        extra_conf={
            "spark.sql.warehouse.dir": warehouse,
            # local mode runs every task in the driver JVM; Spark's 1g default
            # heap makes a long benchmark session GC-bound
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
        },
    )
    timings: dict[str, float] = {}
    run_layers = not sys.argv[1:] or "layer_runner_end_to_end" in names
    names = [n for n in names if n != "layer_runner_end_to_end"]
    for name in names:
        fn = QUERIES[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(samples), 3)
    if run_layers:
        # the whole layered job (raw, cleansed, metric tables, views, audit),
        # the unit the source programme reports its wall time for
        from perkspark.plans.pipeline import LoyaltyPipeline
        from perkspark.plans.runner import LayerRunner

        samples = []
        for i in range(min(runs, 3) + 1):
            t0 = time.perf_counter()
            LayerRunner(spark, LoyaltyPipeline.from_warehouse(spark, sf_dir)).run().collect()
            if i:  # first run warms up
                samples.append(time.perf_counter() - t0)
        timings["layer_runner_end_to_end"] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_sec",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": sf,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
