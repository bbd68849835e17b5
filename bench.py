"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data (default sf0.1), BENCH_CPUS the local threads (default 8). Each
query is run once to warm up and then timed; its result goes to a sink that reads every
column of every row.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidecast.catalog import all_queries  # noqa: E402
from tidecast.session import build_session, use_local_dir  # noqa: E402

HEADLINE = [
    "D1_hourly_mean",
    "E1_latest_wins",
    "B9_normalize_iso_forecast",
    "C1_lag_features",
    "C3_last_known",
    "C6_training_frame",
    "C7_latest_vintage",
    "C9_vintage_or_fallback",
    "D4_mape_nullable",
    "D5_score_days",
    "D11_psi",
    "D13_ks_2samp",
    "D14_context_table",
    "D18_validate",
    "D20_data_fingerprint",
    "E7_alert_transitions",
    "A9_upsert",
    "J1_process",
    "J1_process_by_series",
    "J2_drift_inputs",
    "J4_backtest_summary",
    "D6_update_errors_incremental",
    "D11_psi_sketched",
    "D18_failure_report",
    "E7_alert_transitions_resumed",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = os.environ.get("BENCH_QUERIES")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    use_local_dir(spark)
    known = all_queries()
    times = {}
    for name in only.split(",") if only else HEADLINE:
        for attempt in range(2):
            start = time.perf_counter()
            known[name](spark, sf).write.format("noop").mode("overwrite").save()
            if attempt:
                times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds, headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf.rstrip("/")),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
