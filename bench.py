"""Times the headline queries: median of the warm runs per query, one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from reqloom import build_session
from reqloom.plans.queries import QUERIES

HEADLINE = (
    "normalize_flat",
    "normalize_log_entries",
    "normalize_text",
    "latency_kpis",
    "latency_hourly",
    "latency_rank_daily",
    "errors_hourly",
    "errors_rolling",
    "top_error_endpoints_daily",
    "sla_hourly",
    "sla_rolling_drift",
    "status_code_kpis",
    "status_families_daily",
    "top_endpoints_per_error_code",
    "user_kpis",
    "user_activity_daily",
    "user_rolling_activity",
    "anomaly_latency_zscore",
    "anomaly_error_spikes",
    "endpoint_degradation_daily",
    "explore_latency_summary",
    "explore_top_endpoints",
    "latency_delta",
    "running_mean",
    "column_stats",
    "iqr_bounds",
    "quality_report",
    "consistency_summary",
    "drift_ks_stat",
    "drift_chi2_stat",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "reqloom-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median warm query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
