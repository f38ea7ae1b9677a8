"""Headline queries: one JSON line with the median seconds of each.

BENCH_SF_DIR (default sf0.1), BENCH_CPUS (default 8) and BENCH_RUNS (default 5) set the run. Every
query runs once to warm up; results go to the noop sink, so that all rows and columns are computed.
"""

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tapework.plans.catalog import QUERIES  # noqa: E402
from tapework.session import local_session  # noqa: E402

HEADLINE = [
    "m3_daily_indicators", "m3_daily_indicators_parts", "m4_indicator_summary", "m5_dividend_yield",
    "m5_dividend_yield_parts", "m5_dividend_yield_by_join", "r5_period_returns", "r6_risk_return",
    "g1_coverage", "g2_yearly_amplitude", "g3_sector_volume", "g4_extreme_returns", "g5_session_gaps",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = local_session("bench", cores=cpus, shuffle_partitions=8, memory="16g")
    seconds = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
    print(json.dumps({
        "metric": "headline_total_warm_median", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": cpus, "runs": runs,
        "conf": {"spark.sql.shuffle.partitions": 8, "spark.sql.adaptive.enabled": True},
    }))


if __name__ == "__main__":
    main()
