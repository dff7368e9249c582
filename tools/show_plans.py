"""Print physical plans of registered queries (and a summary of exchanges,
joins, aggregates and Python steps) for plan review.

    python tools/show_plans.py [--sf DIR] [--full] name ...
"""

from __future__ import annotations

import argparse
import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.plans import registry  # noqa: E402
from tidewater.session import build_session  # noqa: E402

MARKERS = ("Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
           "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate", "ObjectHashAggregate", "SortAggregate",
           "Window", "ArrowEvalPython", "BatchEvalPython", "Generate", "TakeOrderedAndProject", "FileScan")


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--full", action="store_true")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = build_session("plans", "local[8]", 16)
    entries = registry.entries()
    for name in args.names or list(entries):
        df = entries[name].fn(spark, args.sf)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("simple")
        plan = buf.getvalue()
        counts = {m: len(re.findall(rf"\b{m}\b", plan)) for m in MARKERS}
        print(f"== {name}: " + ", ".join(f"{k}={v}" for k, v in counts.items() if v))
        for line in plan.splitlines():
            if "ReadSchema" in line or "PushedFilters" in line:
                for part in ("PushedFilters: [^]]*]", "ReadSchema: \\S+"):
                    m = re.search(part, line)
                    if m:
                        print("   ", m.group(0)[:200])
        if args.full:
            print(plan)
    spark.stop()


if __name__ == "__main__":
    main()
