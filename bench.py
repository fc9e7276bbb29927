"""Wall time of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the table folder and ``BENCH_CPUS`` the cores. Every
query is written to the ``noop`` sink, so all rows and columns are computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hazeline.session import build_session, clear_work  # noqa: E402
from suite import catalog  # noqa: E402

HEADLINE = [
    "features_all", "w1_trailing_mean", "w3_row_lags_by_station", "w8_sequences", "w9_stuck_zero",
    "j1_nearest_asof", "j1_nearest_asof_window", "j2_calendar_flags", "j6_semivariogram", "a1_regression_metrics",
    "a4_psi", "a7_failure_counts", "a8_optimize_weights", "a16_profile", "a17_request_rate", "s3_sensor_feed",
    "s10_online_snapshot", "u3_alert_union", "m1_seasonal_regression", "m3_isolation_forest", "m4_ward_kriging",
    "m7_forecast_all_stations", "m2_window_products", "x4_hourly_means", "x5_stream_faults",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = catalog()
    # One small run starts the session's workers and loads the engine's classes.
    queries["f1_clock_parts"](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
        clear_work(spark)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(folder.rstrip("/")).replace("sf", "")}))


if __name__ == "__main__":
    main()
