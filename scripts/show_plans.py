"""Print the shape of each registered query's physical plan.

Usage: python scripts/show_plans.py [sf_dir] [name ...]

Per query: the exchanges (what each shuffle is keyed on), aggregation and
window nodes (partial or final), and the scans with the columns they read.
Use ``--full`` for the complete formatted plan.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KEEP = ("Exchange", "FileScan", "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Window",
        "WindowGroupLimit", "Scan", "Expand", "Generate", "BroadcastHashJoin",
        "SortMergeJoin", "Union")


def shape(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        stripped = line.strip("+-: *()0123456789")
        if not any(stripped.startswith(k) for k in KEEP):
            continue
        text = re.sub(r"#\d+L?", "", line.rstrip())
        text = re.sub(r", \[plan_id=\d+\]", "", text)
        if "FileScan" in text:
            indent = text[:text.index("+-") + 3] if "+-" in text else ""
            fmt = re.search(r"FileScan (\w+)", text)
            pushed = re.search(r"PushedFilters: (\[[^\]]*\])", text)
            schema = re.search(r"ReadSchema: (\S+)", text)
            parts = [f"FileScan {fmt.group(1) if fmt else ''}"]
            if pushed:
                parts.append(f"PushedFilters: {pushed.group(1)}")
            if schema:
                parts.append(f"ReadSchema: {schema.group(1)}")
            text = indent + ", ".join(parts)
            out.append(text)
            continue
        out.append(text[:170])
    return out


def main(argv: list[str]) -> None:
    full = "--full" in argv
    args = [a for a in argv[1:] if a != "--full"]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    only = [a for a in args if not os.path.isdir(a)]
    from feedlake.plans.registry import QUERIES
    from feedlake.session import build_session

    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "16",
                                         "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        df = fn(spark, sf_dir)
        print(f"## {name}")
        if full:
            df.explain("formatted")
            continue
        plan = df._jdf.queryExecution().executedPlan().toString()
        print("```")
        print("\n".join(shape(plan)))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
