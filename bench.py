"""Time the headline queries: prints one JSON line.

``BENCH_SF_DIR`` names the tables (default ``/root/testdata/sf0.1``), ``BENCH_CPUS`` the cores.
Each query runs once to warm up and then ``BENCH_RUNS`` times into a sink that keeps nothing;
the median counts.
"""

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from checks.registry import QUERIES

HEADLINE = [
    "daily_trends",
    "daily_metrics",
    "daily_metrics_by_date",
    "daily_document",
    "weekly_trends",
    "customer_segments_fixed",
    "customer_segments_quantile",
    "customer_lifetime",
    "product_performance",
    "price_patterns",
    "business_metrics",
    "analytics_report",
    "clean_for_ml",
    "clean_for_ml_aggressive",
    "clean_orders_scan",
    "cleaning_report",
    "quality_report",
    "duplicate_rows",
    "training_sample",
    "revenue_forecast",
    "prediction_summary",
    "matched_orders_by_user",
    "littles_law",
    "session_report",
    "appended_metrics",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ordermill-"))
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        times = []
        for _ in range(runs + 1):
            began = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(name, [round(t, 2) for t in times], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total median seconds of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
