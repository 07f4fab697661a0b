"""Wall seconds of the headline queries, second run each: prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the cores, ``BENCH_QUERIES`` (comma separated, or
``all``) other queries than the headline ones. A query whose first run takes longer than ``LONG`` seconds is not
run again, one that takes longer than ``BENCH_QUERY_SECONDS`` is stopped, and after ``BENCH_SECONDS`` in all, or when
the bench is told to end, the rest is left out; what was stopped or left out is named beside the figures.
"""

from __future__ import annotations

import json
import os
import signal
import sys
import threading
import time

from obsloom.plans.catalog import QUERIES
from obsloom.session import local_session

#: The dearest come last.
HEADLINE = [
    "region_extreme_counts", "label_v2_counts", "levels_right_closed", "wind_encoding", "risk_score", "infer_numeric",
    "lag_features", "lag_features_sliced", "daily_range", "latest_per_city", "region_lookup", "impute_median",
    "city_summary", "top_cities", "rollup_report", "class_balance", "null_audit", "duplicate_audit", "column_profile",
    "describe_numeric", "iqr_outliers", "histogram40", "box_stats", "box_stats_by_rank", "corr_matrix", "monthly_trend",
    "seasonality", "month_hour_matrix", "extreme_by_day_filled", "stratified_split", "kfold_assignment",
    "standard_scale", "roc_auc_rank", "macro_metrics", "freq_itemsets", "rules_all", "kmeans_line_items",
    "bronze_to_silver", "stream_lag", "kmeans_sweep", "nearest_in_class", "smote_balanced", "rf_scores", "gbt_scores",
    "cv_leaderboard",
]
LONG = 40.0


def seconds(spark, run, sf_dir: str, limit: float) -> float:
    """Wall seconds of one run; its jobs are cancelled after ``limit``, which makes it fail."""
    stop = threading.Timer(limit, spark.sparkContext.cancelAllJobs)
    stop.daemon = True
    stop.start()
    start = time.perf_counter()
    try:
        run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    finally:
        stop.cancel()
    return time.perf_counter() - start


def told_to_end(signum, frame) -> None:
    raise SystemExit(f"signal {signum}")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    wanted = os.environ.get("BENCH_QUERIES")
    each, whole = (float(os.environ.get(k, d)) for k, d in (("BENCH_QUERY_SECONDS", "400"), ("BENCH_SECONDS", "1500")))
    names = HEADLINE if not wanted else list(QUERIES) if wanted == "all" else wanted.split(",")
    signal.signal(signal.SIGTERM, told_to_end)
    began = time.perf_counter()
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.range(1_000_000).selectExpr("sum(id)").collect()  # the first job of a session starts its threads
    times: dict[str, float] = {}
    left_out: dict[str, str] = {}
    try:
        for name in names:
            left = whole - (time.perf_counter() - began)
            if left <= 0:
                left_out[name] = "no time left"
                continue
            try:
                took = seconds(spark, QUERIES[name], sf_dir, min(each, left))
                if took <= LONG:
                    took = seconds(spark, QUERIES[name], sf_dir, min(each, left))
            except Exception as error:  # noqa: BLE001
                left_out[name] = f"{type(error).__name__} after {min(each, left):.0f} s at most"
                continue
            times[name] = round(took, 3)
            print(f"{times[name]:8.3f} {name}", file=sys.stderr, flush=True)
    finally:
        scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
        total = round(sum(times.values()), 3)
        left_out |= {n: "not reached" for n in names if n not in times and n not in left_out}
        found = {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": float(scale)}
        print(json.dumps(found | ({"left_out": left_out} if left_out else {})), flush=True)


if __name__ == "__main__":
    main()
