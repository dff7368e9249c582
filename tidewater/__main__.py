"""Command line: list the registered queries, run one.

    python -m tidewater list
    python -m tidewater run word_count --sf /root/testdata/sf0.01 --show 20
    python -m tidewater run course_scores --sf DIR --out /shared/results/course_scores
    python -m tidewater sql word_count          # the DuckDB oracle SQL of a query

``run`` writes the full result as parquet with ``--out`` (on a cluster: a
shared path) or shows the first rows; it never collects the whole result.
"""

from __future__ import annotations

import argparse
import sys

from tidewater.plans import registry


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tidewater")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="registered queries with the inventory ids they cover")
    run = sub.add_parser("run", help="run one query")
    run.add_argument("name")
    run.add_argument("--sf", default="/root/testdata/sf0.01", help="folder with the <table>.parquet inputs")
    run.add_argument("--out", help="write the result here as parquet")
    run.add_argument("--show", type=int, default=20, help="rows to print when --out is not given")
    run.add_argument("--master", default=None, help="e.g. local[8]; default: from spark-submit / config")
    run.add_argument("--explain", action="store_true", help="print the formatted physical plan")
    sql = sub.add_parser("sql", help="print a query's oracle SQL")
    sql.add_argument("name")
    args = ap.parse_args(argv)

    entries = registry.entries()
    if args.cmd == "list":
        for name, e in entries.items():
            check = "oracle" if e.sql else "rows"
            print(f"{name:28s} {check:7s} {' '.join(e.ops)}")
        return 0
    if args.name not in entries:
        print(f"unknown query {args.name!r}; see `python -m tidewater list`", file=sys.stderr)
        return 2
    if args.cmd == "sql":
        print(entries[args.name].sql or "-- no SQL oracle: checked by rows and tests")
        return 0

    from tidewater.session import build_session

    spark = build_session(f"tidewater-{args.name}", args.master)
    df = entries[args.name].fn(spark, args.sf)
    if args.explain:
        df.explain("formatted")
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
        print(f"wrote {args.out}")
    else:
        df.show(args.show, truncate=False)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
