"""Time the oracle SQL on DuckDB for the headline marts:
a single-node reference point for bench.py at the same scale.

    python tools/literal_baseline.py [sf_dir] [runs]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from martcraft.plans.oracle import oracle_queries  # noqa: E402
from tools.compare import duck  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    runs = int(argv[2]) if len(argv) > 2 else 3
    con = duck(sf_dir)
    qs = oracle_queries()
    times = {}
    for name in HEADLINE:
        def once():
            t0 = time.perf_counter()
            con.execute(f"SELECT count(*) FROM ({qs[name]})").fetchall()
            return time.perf_counter() - t0
        once()
        times[name] = round(statistics.median(once() for _ in range(runs)), 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    print(json.dumps({"engine": "duckdb-literal", "value": round(sum(times.values()), 3),
                      "queries": times, "sf_dir": sf_dir}))


if __name__ == "__main__":
    main(sys.argv)
