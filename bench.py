"""Benchmark: build every mart (and the data check) at $BENCH_SF_DIR on
local[$BENCH_CPUS] and print one JSON line.

Each query is executed to completion through the ``noop`` sink (all rows
produced, nothing collected to the driver); the reported time per query is
the median of $BENCH_RUNS warm runs after one warm-up run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "kit_sales_v2", "retail_sales_v2", "balance_v2",
    "kit_sales_v1", "retail_sales_v1", "balance_v1",
    "kit_sales_interim", "retail_sales_interim", "balance_interim",
    "check_target",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from martcraft.plans.registry import queries
    from martcraft.session import local_session, stage_run

    n = int(cpus) if cpus.isdigit() else os.cpu_count() or 8
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * n), app="martcraft-bench")
    qs = queries()
    names = only or list(HEADLINE)
    times: dict[str, float] = {}
    for name in names:
        def once() -> float:
            t0 = time.perf_counter()
            with stage_run(spark):
                qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0
        once()  # warm-up
        times[name] = round(statistics.median(once() for _ in range(runs)), 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({
        "metric": "marts_total_median_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
