"""Wall time of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores. All queries run once to warm up and then
three times each; the median counts. Results go to the ``noop`` sink, so every row is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from hazeline.plans.queries import QUERIES
from hazeline.session import local_session

HEADLINE = (
    "gold_mart",
    "gold_mart_by_user",
    "latest_version_by_user",
    "latest_shipment_version",
    "version_history",
    "bronze_to_gold",
    "payload_verdicts",
    "silver_aqi",
    "dq_report",
    "dq_hourly_gaps_by_user",
    "daily_summary_by_user",
    "melt_metrics",
    "peak_hour_by_date",
    "status_rows",
    "freshness_by_user",
)
RUNS = 3


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = local_session(cpus, "bench")
    for name in HEADLINE:
        seconds(spark, name, sf_dir)
    times = {}
    for name in HEADLINE:
        times[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
