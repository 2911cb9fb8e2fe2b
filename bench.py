"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line with per-query wall-clock seconds.

Each query is planned from scratch (no derived table shared between
queries) and fully executed into Spark's no-op sink, so the time covers the
scan, joins, shuffles and output without collecting rows to the driver.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from demandkit.plans import context, registry  # noqa: E402
from demandkit.session import build_session  # noqa: E402

HEADLINE = [
    "demand_features",        # flagship: daily series, lags, rolling windows
    "daily_demand",
    "select_features",        # full preparation: encode + scale
    "product_brand_forecast",
    "inventory_optimization",
    "stock_health",
    "recommendations",
    "regression_metrics",
    "histogram",
    "contiguous_folds",
    "profile_describe",
    "correlation",
    "drift_monitor",
    "stream_daily_demand",
    "nightly_scoring",
    "nightly_insights",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    if not cpus.isdigit():  # e.g. "*": all cores of the machine
        cpus = str(os.cpu_count() or 8)
    spark = build_session("demandkit-bench", cpus=cpus, shuffle_partitions=int(cpus) * 2)
    # Optional stage/task timings: Spark's event log into a scratch folder
    # (BENCH_EVENT_LOG_DIR); the web UI stays off.
    log_dir = os.environ.get("BENCH_EVENT_LOG_DIR")
    if log_dir:
        spark.stop()
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master(f"local[{cpus}]").appName("demandkit-bench")
                 .config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true")
                 .config("spark.eventLog.dir", log_dir)
                 .config("spark.sql.shuffle.partitions", str(int(cpus) * 2))
                 .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    qs = registry.query_callables()
    names = [n for n in HEADLINE if n in qs]
    # Warm-up: JVM start, class loading and codegen caches.
    qs["daily_demand"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        context.reset()
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_wall_clock",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
