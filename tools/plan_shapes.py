"""Print the README's plan-shape table: operator counts in the physical plan
of staging and of every OLAP query (``explain("formatted")``).

Usage: python tools/plan_shapes.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COLUMNS = [("shuffles", r"\bExchange\b"), ("broadcasts", r"BroadcastExchange"),
           ("broadcast joins", r"BroadcastHashJoin"), ("sort-merge joins", r"SortMergeJoin"),
           ("hash agg", r"HashAggregate"), ("sort agg", r"SortAggregate"), ("window", r"\bWindow\b"),
           ("group limit", r"WindowGroupLimit"), ("top-k", r"TakeOrderedAndProject")]
QUERIES = ["q1", "q1_top5_each", "q2", "q3", "q4", "q5", "q6", "q7", "q8", "q9", "q10"]


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    return text[:text.index("\n\n(1)")]


def main(sf_dir: str) -> None:
    from starling.operators import olap
    from starling.plans import build as P
    from starling.session import build_session
    spark = build_session()
    wh = P.warehouse(spark, sf_dir)
    plans = [("staging", P.staging(spark, sf_dir))] + [(q, getattr(olap, q)(wh)) for q in QUERIES]
    print("| plan | " + " | ".join(c for c, _ in COLUMNS) + " |")
    print("|---|" + "---|" * len(COLUMNS))
    for name, df in plans:
        t = tree(df)
        print(f"| {name} | " + " | ".join(str(len(re.findall(p, t))) for _, p in COLUMNS) + " |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
