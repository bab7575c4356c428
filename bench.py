"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default all) choose input and cores.
Every query is built and run to the end into a sink that discards its rows.
"""

from __future__ import annotations

import json
import os
import re
import time

from hydrosignal.catalog import load
from hydrosignal.session import build_session

HEADLINE = [
    "flagship_hourly_rain_features",
    "e1_hourly_rollup",
    "e2_daily_rollup",
    "f4_antecedent_rainfall",
    "f5_f6_rolling_means_and_changes",
    "f10_hours_since_event",
    "f11_interpolate_in_time",
    "i3_flow_predictor_table",
    "a7_metar_hourly_function",
    "a10_upsert_by_key",
    "d7_flags_covering_predictions",
    "d8_rain_sum_bins",
    "d15_asof_join",
    "e8_cross_tab_with_totals",
    "j1_stratified_split",
    "j11_auc",
    "j12_cutoff_sweep",
    "j13_confusion_and_rates",
    "j16_score_many_models",
    "j22_up_sampling",
    "j23_univariate_screening",
    "k2_status_of_every_prediction",
    "k3_seven_day_feed",
    "m3_weather_predictors",
    "m7_labelled_samples",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    parallel = cpus if cpus != "*" else str(os.cpu_count())
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        **{
            "spark.sql.shuffle.partitions": parallel,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry = load()
    spark.read.parquet(f"{folder}/events.parquet").count()
    times = {}
    for name in HEADLINE:
        start = time.time()
        registry.queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
