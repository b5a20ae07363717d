"""Time the headline queries: median of warm runs, every row and column computed and thrown away."""

from __future__ import annotations

import json
import os
import statistics
import time

from tradeloom.plans.queries import QUERIES, forget_stores
from tradeloom.session import local_session

HEADLINE = [
    "bronze_unified",
    "normalize_trades",
    "silver_valid",
    "silver_rejected",
    "silver_dedupe",
    "silver_insert_if_absent",
    "silver_latest",
    "ohlc",
    "ohlc_1h",
    "ohlc_history",
    "vwap",
    "maker_taker_flow",
    "whale_alert",
    "merge_ohlc",
    "merge_flow",
    "merge_vwap",
    "merge_upsert_generic",
    "merge_whale",
    "ohlc_latest",
    "whale_latest_symbol",
    "dashboard_summary",
    "dashboard_by_symbol",
    "gold_stats",
    "stream_ohlc",
    "stream_silver",
]
# What these time is the writing of the tables; all other queries scan tables that the warm-up has written.
WRITING = {"stream_ohlc", "stream_silver"}


def timed(name: str, spark, sf_dir: str) -> float:
    if name in WRITING:
        forget_stores()
    query = QUERIES[name]
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench", **{"spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        timed(name, spark, sf_dir)
        seconds[name] = round(statistics.median(timed(name, spark, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_warm_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
