"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
The warehouse is built once, timed as ``pipeline``. Every other query runs once to warm up and then
BENCH_RUNS times; its figure is the median. Results are consumed in full by a no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from quotemill.session import build_session
from quotemill.suite.queries import QUERIES
from quotemill.suite.scratch import warehouse

HEADLINE = [
    "q1_rolling_marketcap",
    "q2_pe_top10",
    "q3_roa_top10",
    "q4_peer_pe",
    "q4_peer_pe_top1",
    "q5_revenue",
    "q6_yoy_lag",
    "q6_yoy_asof",
    "q4_peer_pe_v1",
    "dedup_last_version",
    "stg_fact_stock",
    "win_rolling_avg",
    "join_star",
    "incr_delete_insert",
    "scd2_company",
    "mask_rare",
    "dq_summary",
]


def timed(fn) -> float:
    start = time.perf_counter()
    fn()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {"pipeline": round(timed(lambda: warehouse(spark, sf_dir)), 3)}
    cold = dict(seconds)

    def run(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    for name in names:
        cold[name] = round(timed(lambda: run(name)), 3)
        seconds[name] = round(statistics.median(timed(lambda: run(name)) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds over headline queries, warm median, plus one pipeline build",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "cold": cold,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
