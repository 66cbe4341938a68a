"""Compare every registered query with its oracle SQL on one scale factor.

Usage: python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import decimal
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from starling.sources.testdata import TABLES  # noqa: E402


def normalise(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral_value() else format(v.normalize(), "f")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(normalise(r[c]) for c in cols) for r in df.collect()), key=repr)


def duck_rows(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    rows = rel.fetchall()
    return cols, sorted((tuple(normalise(r[i]) for i in idx) for r in rows), key=repr)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as entry_mod
    from starling.session import build_session
    extra = {}
    if os.environ.get("COMPARE_ANSI"):
        extra["spark.sql.ansi.enabled"] = os.environ["COMPARE_ANSI"]
    if os.environ.get("COMPARE_PLAIN"):
        # a session with Spark's defaults, as a driver might create it
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = build_session(extra_conf=extra)
    if os.environ.get("COMPARE_TZ"):
        spark.conf.set("spark.sql.session.timeZone", os.environ["COMPARE_TZ"])
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, sql = entry_mod.queries(), entry_mod.oracle_sql()
    results = {}
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            scols, srows = spark_rows(fn(spark, sf_dir))
            dt = time.time() - t0
            if name not in sql:
                results[name] = {"rows": len(srows), "oracle": None, "sec": round(dt, 2)}
                continue
            dcols, drows = duck_rows(con, sql[name])
            ok = scols == dcols and srows == drows
            res = {"ok": ok, "rows": len(srows), "oracle_rows": len(drows), "sec": round(dt, 2)}
            if not ok:
                res["cols"] = [scols, dcols]
                diff_s = [r for r in srows if r not in set(drows)][:3]
                diff_d = [r for r in drows if r not in set(srows)][:3]
                res["spark_only"] = [list(map(str, r)) for r in diff_s]
                res["oracle_only"] = [list(map(str, r)) for r in diff_d]
            results[name] = res
        except Exception as e:  # report and go on with the next query
            results[name] = {"error": repr(e)[:2000]}
        print(name, json.dumps(results[name]), flush=True)
    bad = [k for k, v in results.items() if not v.get("ok", v.get("oracle", 1) is None)]
    print("FAILED:", bad)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
