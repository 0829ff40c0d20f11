"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads. All queries run
once to warm up the JVM and then three times each; a query's time is the median. A run evaluates every
output column and keeps none of them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lookback.plans.catalog import QUERIES  # noqa: E402
from lookback.session import build_session  # noqa: E402

HEADLINE = [
    "click_features",
    "click_features_join",
    "click_features_binned",
    "pit_orders_90d",
    "pit_orders_90d_binned",
    "pit_foreign_spine",
    "pit_event_log",
    "event_daily_rollup",
    "conform_dedup_set",
    "label_lookup",
    "dq_events",
    "dq_payments",
    "dq_pk_unique",
    "dq_latest",
    "dq_quarantine",
    "ingest_jsonl_typed",
    "publish_clustered",
    "feature_snapshot_diff",
    "training_set",
    "layered_features",
    "click_model_scores",
    "ingest_stream_available_now",
]
# The heavy jobs run once after the warm-up.
ONCE = {"layered_features", "click_model_scores", "ingest_stream_available_now"}
RUNS = 3


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "lookback-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in HEADLINE:
        seconds(spark, name, sf_dir)
    times = {}
    for name in HEADLINE:
        times[name] = round(
            statistics.median(
                seconds(spark, name, sf_dir) for _ in range(1 if name in ONCE else RUNS)
            ),
            3,
        )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
