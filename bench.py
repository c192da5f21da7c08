"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3) and BENCH_QUERIES (comma
separated names). Each query runs once to warm up; its time is the median of the runs after that. `value` is the
sum of those medians. Every row of a result is produced; results go to Spark's no-op sink.
"""

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from candlewick.plans.registry import registered  # noqa: E402
from candlewick.session import build_session  # noqa: E402

HEADLINE = (
    "ohlcv_5min",
    "ohlcv_1day",
    "ohlcv_sliding_5min_1min",
    "ohlcv_1day_hot_symbols",
    "trading_signals_15min",
    "trading_signals_1day_hot_symbols",
    "latest_signals",
    "alert_history",
    "rsi_14",
    "dead_letters",
    "topic_messages",
    "component_health",
    "bars_from_bronze",
    "stream_bronze",
    "stream_bars_5min",
    "stream_signals_15min",
)


def seconds(query, spark, sf_dir: str) -> float:
    began = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, times = registered(), {}
    for name in chosen:
        seconds(queries[name], spark, sf_dir)
        times[name] = round(statistics.median(seconds(queries[name], spark, sf_dir) for _ in range(runs)), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of median seconds",
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
