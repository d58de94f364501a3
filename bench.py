"""Headline queries, timed once each after a warm-up; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from weekloom.queries import QUERIES
from weekloom.session import local_session

HEADLINE = (
    "weekly_mean",
    "genre_weekly_sum",
    "topn_genres",
    "genre_naive_report",
    "tune_ma_window",
    "autoregressive_forecast",
    "seasonal_ar_forecast",
    "grid_tuned_trend_season",
    "ts_features",
    "resample_weekly_fill0",
    "dedup_keep_first",
    "join_by_id_left",
    "tag_frequency_topn",
    "label_occurrences",
    "one_hot_multilabel",
    "best_per_group_composite",
    "dtw_distance",
    "acf",
    "pacf",
    "decompose_additive",
    "numeric_profile",
    "box_stats",
    "histogram",
    "correlation_matrix",
    "tidy",
    "chart_page_rows",
    "flatten_track_album",
)


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus), app="weekloom-bench")
    spark.sparkContext.setLogLevel("ERROR")
    timed(spark, "genre_naive_report", sf_dir)
    took = {name: timed(spark, name, sf_dir) for name in HEADLINE}
    match = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": float(match.group(1)) if match else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
