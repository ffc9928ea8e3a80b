"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores. Every query runs once cold
and then ``BENCH_RUNS`` times; ``queries`` has the median of the warm runs, ``value`` their
sum. Results are written to Spark's ``noop`` sink, so all rows and columns are computed.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tickloom.catalog import QUERIES
from tickloom.session import local_session

HEADLINE = (
    "valid_ticks", "hourly_stats", "hourly_ohlc", "session_summary", "trade_distribution",
    "block_trade_distribution", "merge_session", "rollups_from_cells",
    "dim_commodity", "dim_date", "fact_session_summary", "fact_hourly_stats", "fact_trade_distribution",
    "comm_change", "top_gainers", "top_losers", "hourly_profile", "trader_type_totals", "volume_share",
    "session_leaderboard", "volume_spikes", "session_trend", "dq_report", "dq_volatility",
    "replace_by_source", "load_star", "file_status", "illegal_transitions", "sla_report",
    "read_tick_zips", "read_tick_csv", "hourly_stats_stream", "load_files", "ingest_stream",
)


def timed(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    cold, warm = {}, {}
    for name in HEADLINE:
        cold[name] = round(timed(spark, sf_dir, name), 3)
        warm[name] = round(statistics.median(timed(spark, sf_dir, name) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline queries, sum of warm medians",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cores": cores,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
