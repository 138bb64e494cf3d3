"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores, BENCH_QUERIES an
optional comma-separated choice. Each query runs once to warm up and once timed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from scorewatch.session import clear_scratch, get_spark

HEADLINE = (
    "psi_by_day", "psi_trend", "drift_report", "ks_two_sample", "roc_auc", "roc_auc_by_month", "calibration_gap",
    "compare_scores", "contract_violations", "request_validation", "token_scan", "temporal_split", "split_stats",
    "temporal_manifest", "feature_stats", "feature_check", "log_analytics", "business_metrics", "replay_detection",
    "histogram_le", "label_noise_flip", "rate_limit", "error_rate", "latency_quantiles", "stream_decisions",
    "active_model_asof", "train_score",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    shared = tempfile.mkdtemp(prefix="bench-")
    spark = get_spark(
        "bench", f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g", spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=f"file://{shared}",
    )
    spark.sparkContext.setLogLevel("ERROR")
    from scorewatch.catalog import QUERIES

    seconds: dict[str, float] = {}
    for name in names:
        for timed in (False, True):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            if timed:
                seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }))
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
