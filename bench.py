"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 2; the best run counts), BENCH_QUERIES (comma-separated names).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from casebeacon.plans.catalog import QUERIES  # noqa: E402
from casebeacon.session import build_session, clear_work_dirs  # noqa: E402

HEADLINE = (
    "clean_cases dedupe_cases upsert_cases validate_required unwrap_envelope wrap_envelope write_parquet_overwrite "
    "positivity_by_region climate_correlation demographics cases_per_minute last_30_buckets recent_cases "
    "age_histogram rain_positivity region_window_features threshold_lower_q75 window_histogram region_date_grid "
    "latest_window_per_region rolling_positive_count outbreak_alerts alert_cooldown confusion_matrix "
    "weighted_metrics auc row_audit dashboard_snapshot analytics_snapshot stream_ingest stream_outbreak_alerts "
    "stream_region_windows stream_live_totals case_risk_model score_cases"
).split()

SLOW = {"case_risk_model", "score_cases"}  # training dominates these; one run is enough


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("OFF")
    QUERIES["region_summary"](spark, sf_dir).collect()  # warms up the JVM

    timings = {}
    for name in names:
        best = None
        for _ in range(1 if name in SLOW else runs):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            elapsed = time.perf_counter() - started
            clear_work_dirs(spark)
            best = elapsed if best is None else min(best, elapsed)
        timings[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, best of runs, summed",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
