"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is built, planned and written to the no-op sink (every row is computed,
nothing is collected). The figure is the median of $BENCH_RUNS runs after a warm-up.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import load_all  # noqa: E402
from checks.catalog import QUERIES  # noqa: E402
from navloom.session import local_session  # noqa: E402

HEADLINE = (
    "p3_nav",
    "a1_adjusted_nav",
    "a2_adjusted_nav_all_funds",
    "a3_return_comparison_detail",
    "a3_return_comparison_summary",
    "a4_trade_day_integrity",
    "a5_candidate_filter",
    "a6_daily_nav_fact",
    "a7_period_return_fact",
    "a8_metric_snapshot",
    "a9_scoreboard",
    "a10_recheck_detail",
    "a11_composite_score",
    "a13_backtest_windows",
    "g16_deviation_shares",
    "w7_global_rank",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    spark = local_session(cores, "navloom-bench")
    spark.sparkContext.setLogLevel("ERROR")
    load_all()
    seconds, building = {}, {}
    for name in names:
        times, builds = [], []
        for _ in range(runs + 1):
            started = time.perf_counter()
            result = QUERIES[name](spark, sf_dir)
            builds.append(time.perf_counter() - started)
            result.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)
        building[name] = round(statistics.median(builds[1:]), 3)
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "building_the_plan": building,
                "sf": float(found.group(1)) if found else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
