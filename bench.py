"""Benchmark: run the query catalogue on one scale and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 2; after one untimed warm-up run per query, the best of
the timed repeats is reported — steady-state throughput, JIT warm; entries that
run a stream in several batches are timed once),
BENCH_ONLY (optional comma-separated subset of query names),
BENCH_GC=1 (optional: force a JVM collection before each query, untimed),
BENCH_XMS (optional initial driver heap, e.g. 8g).
Each query is fully executed into the ``noop`` sink (no driver collect).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from aerostream.plans.catalog import QUERIES  # noqa: E402
from aerostream.plans.streams import STREAM_QUERIES  # noqa: E402
from aerostream.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    extra = {"spark.driver.memory": "16g"}
    if os.environ.get("BENCH_XMS"):
        extra["spark.driver.extraJavaOptions"] = f"-Xms{os.environ['BENCH_XMS']}"
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, extra=extra)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    # warm the JVM and the parquet footer cache once
    QUERIES["flight_count"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    times: dict[str, float] = {}
    for name, q in QUERIES.items():
        if only and name not in only:
            continue
        if os.environ.get("BENCH_GC", "0") == "1":
            spark.sparkContext._jvm.System.gc()  # untimed: start each query with a collected heap
        q(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        best = None
        for _ in range(1 if name in STREAM_QUERIES else repeat):
            t0 = time.perf_counter()
            q(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 4)
    total = round(sum(times.values()), 4)
    print(json.dumps({"metric": "catalogue_total_sec", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
