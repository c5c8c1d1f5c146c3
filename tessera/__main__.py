"""Command line: list or run catalogue queries.

    python -m tessera list
    python -m tessera run <query> --sf-dir DIR [--out PATH --format csv|parquet] [--show N]
        [--master local[4]]

``run`` writes the whole result with the DataFrame writer (CSV with header by
default, like the reference jobs' outputs) or shows the first N rows.
"""

from __future__ import annotations

import argparse
import sys

from tessera.plans.catalog import ORACLE_SQL, QUERIES
from tessera.session import build_session, delete_scratch
from tessera.sources.sinks import preview, write_csv, write_parquet


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tessera")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list the registered queries")
    run = sub.add_parser("run", help="run one query")
    run.add_argument("query", choices=sorted(QUERIES))
    run.add_argument("--sf-dir", required=True, help="folder with <table>.parquet files")
    run.add_argument("--out", help="output path (shared storage on a cluster)")
    run.add_argument("--format", choices=["csv", "parquet"], default="csv")
    run.add_argument("--show", type=int, default=0, help="print the first N rows instead of writing")
    run.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    args = ap.parse_args(argv)

    if args.cmd == "list":
        for name in sorted(QUERIES):
            print(f"{name}{'' if name in ORACLE_SQL else '  (no SQL oracle)'}")
        return 0

    spark = build_session(args.master, app_name=f"tessera-{args.query}")
    df = QUERIES[args.query](spark, args.sf_dir)
    if args.show or not args.out:
        preview(df, args.show or 20).show(truncate=False)
    else:
        (write_csv if args.format == "csv" else write_parquet)(df, args.out)
        print(f"wrote {args.query} to {args.out}")
    delete_scratch(spark)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
