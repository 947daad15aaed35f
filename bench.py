"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) names the tables, ``BENCH_CPUS`` (default 8)
the local cores. Each query runs to completion into a sink that discards rows; the second of two
runs counts, and includes the jobs a query starts while it is built.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import registry  # noqa: E402
from stridelake.session import configure  # noqa: E402

HEADLINE = [
    "header_stats", "rides_by_year", "moving_averages_by_year", "rides_by_local_hour",
    "class_rides_by_year", "rides_in_trailing_months", "recovery_weeks", "weekly_volume",
    "ride_bundles", "class_sessions", "strength_sessions", "rides_by_month_and_kind",
    "window_headline", "activities_during_life_events", "weekly_volume_with_mean_weight",
    "heart_rate_by_elevation_band", "id_reconciliation", "weight_issues", "life_event_issues",
    "ingest_activities", "ingest_track_points", "xml_activities", "names_filled",
    "weight_readings",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        query, _ = registry.ALL[name]
        for _ in range(2):
            began = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - began, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
