"""Headline queries on local cores; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores, BENCH_RUNS the timed runs
per query (the median counts, after one warm-up run).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from siltwatch.catalog import all_queries
from siltwatch.session import local_session

HEADLINE = (
    "subnet_minute_health",
    "a13_dead_letters",
    "c1_subnet_v4",
    "c4_size_batches",
    "c7_carry_over",
    "c9_batch_bounds",
    "e1_counts",
    "e4a_z_score",
    "e8_suspicious",
    "e10_client_batches",
    "f6_feature_vector",
    "f10_window_frame",
    "f11_jaro_family",
    "f16_alerts",
    "tunnel_end_to_end",
    "h1_alerts_1m",
    "h4_alerts_history",
    "h5_fill_levels_history",
    "h12_roundtrip_latency",
    "h14_latency_values",
    "h15_latency_1h",
    "h17_latency_history",
    "h27_top_clients",
    "h29_detector_outputs",
    "i3_training_windows",
    "i7_split",
    "i15_metrics_per_dataset",
    "i18_distribution_distances",
)


def timed(spark, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, partitions=8 if cpus == "*" else int(cpus), memory=os.environ.get("BENCH_MEMORY", "6g"))
    queries, seconds = all_queries(), {}
    for name in names:
        timed(spark, queries[name], sf_dir)
        seconds[name] = round(statistics.median(timed(spark, queries[name], sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of median warm seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
