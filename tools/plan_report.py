"""Write PLANS.md: the physical plan shape of every catalogue query.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
Each plan is shown as its operator tree (expressions elided), with the scan's
columns and pushed filters, to check shuffles, pruning and aggregation shape.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from aerostream.plans.catalog import QUERIES  # noqa: E402
from aerostream.plans.streams import STREAM_QUERIES  # noqa: E402
from aerostream.session import build_session  # noqa: E402


def shape(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        m = re.match(r"^([\s:+\-|]*)(\w+)(.*)$", line)
        if not m:
            continue
        prefix, node, rest = m.groups()
        if node == "FileScan" or node == "Scan":
            cols = re.search(r"ReadSchema: (struct<[^>]*>)", rest)
            pushed = re.search(r"PushedFilters: (\[[^\]]*\])", rest)
            extra = f" ReadSchema={cols.group(1) if cols else '?'} PushedFilters={pushed.group(1) if pushed else '[]'}"
        elif node in ("Exchange",):
            part = re.search(r"(hashpartitioning\([^,]*|SinglePartition|RoundRobinPartitioning\(\d+\)|rangepartitioning\([^,]*)", rest)
            extra = f" {part.group(1)}" if part else ""
        elif node == "TakeOrderedAndProject":
            lim = re.search(r"limit=(\d+)", rest)
            extra = f" limit={lim.group(1)}" if lim else ""
        else:
            extra = ""
        out.append(f"{prefix}{node}{extra}")
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    print("# Physical plans of the catalogue\n")
    print(f"Generated by `python tools/plan_report.py {sf_dir}` (initial AQE plans; expressions elided).\n")
    for name, q in QUERIES.items():
        if name in STREAM_QUERIES:
            continue
        plan = q(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        print(f"## {name}\n\n```")
        print("\n".join(shape(plan)))
        print("```\n")
    from aerostream.operators.state import latest_flight
    from aerostream.sources.tables import flights

    plan = latest_flight(flights(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    print("## latest_flight, plan chosen for inputs above one file split\n\n```")
    print("\n".join(shape(plan)))
    print("```\n")
    print("Stream-backed entries (" + ", ".join(STREAM_QUERIES) + ") run the streaming operators through"
          " their sinks; their plans are the streaming forms of the batch plans above.")


if __name__ == "__main__":
    main()
