"""Time the SQL oracle in DuckDB (single node) on one scale, one JSON line.

Usage: python tools/duck_bench.py [sf_dir] [threads]
Same protocol as bench.py: one warm-up run, best of two timed runs, result
fully materialised.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from aerostream.plans.oracle import SQL  # noqa: E402
from tools.oracle_check import duck  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    threads = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    con = duck(sf_dir)
    con.execute(f"SET threads = {threads}")
    times = {}
    for name, sql in SQL.items():
        con.sql(sql).fetchall()
        best = None
        for _ in range(2):
            t0 = time.perf_counter()
            con.sql(sql).fetchall()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 4)
    print(json.dumps({"engine": "duckdb", "threads": threads, "value": round(sum(times.values()), 4),
                      "queries": times}))


if __name__ == "__main__":
    main()
