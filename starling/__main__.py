"""Command line: build the warehouse from a folder of test tables and run queries.

    python -m starling list
    python -m starling run q1 q10 --sf-dir /root/testdata/sf0.01 --rows 20
    python -m starling sql "SELECT count(*) FROM sales" --sf-dir /root/testdata/sf0.01
    python -m starling files --feed feed/ --customers customer_master.csv --products product_master.csv --year 2019
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="starling")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list the registered queries")
    run = sub.add_parser("run", help="run registered queries and show their rows")
    run.add_argument("names", nargs="+")
    run.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    run.add_argument("--rows", type=int, default=20)
    fb = sub.add_parser("files", help="build the warehouse from CSV files in the original layout, run queries")
    fb.add_argument("--feed", required=True, help="folder of transaction CSV files")
    fb.add_argument("--customers", required=True, help="customer master CSV (file or folder)")
    fb.add_argument("--products", required=True, help="product master CSV (file or folder)")
    fb.add_argument("--queries", nargs="*", default=["q1", "q2", "q3", "q4", "q5", "q6", "q7", "q8", "q9", "q10"])
    fb.add_argument("--year", type=int, default=None, help="year of Q1 and Q2")
    fb.add_argument("--rows", type=int, default=20)
    sql = sub.add_parser("sql", help="run SQL over the warehouse views")
    sql.add_argument("text")
    sql.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    sql.add_argument("--rows", type=int, default=20)
    args = ap.parse_args(argv)

    from starling.plans.registry import QUERIES
    if args.cmd == "list":
        for name, fn in QUERIES.items():
            print(f"{name:26s} {(fn.__doc__ or '').strip().splitlines()[0] if fn.__doc__ else ''}")
        return 0

    from starling.session import build_session
    spark = build_session()
    if args.cmd == "files":
        from starling.operators import olap
        from starling.plans import files
        wh = files.warehouse_from_files(spark, args.feed, args.customers, args.products)
        wh.register_views()
        for name in args.queries:
            kw = {"year": args.year} if args.year is not None and name in ("q1", "q2") else {}
            print(f"== {name}")
            getattr(olap, name)(wh, **kw).show(args.rows, truncate=False)
    elif args.cmd == "run":
        for name in args.names:
            print(f"== {name}")
            QUERIES[name](spark, args.sf_dir).show(args.rows, truncate=False)
    else:
        from starling.plans import build as P
        P.warehouse(spark, args.sf_dir).register_views()
        spark.sql(args.text).show(args.rows, truncate=False)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
