"""Every registered query against its DuckDB oracle SQL, on the sf0.001 tables,
plus invariants that tie the results together."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from starling.plans.registry import QUERIES
from starling.sources.testdata import TABLES
from tests.compare import duck_rows, spark_rows
from tests.conftest import SMOKE_DIR


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SMOKE_DIR}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_oracle_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    s_cols, s_rows = spark_rows(entry.queries()[name](spark, SMOKE_DIR))
    d_cols, d_rows = duck_rows(duck, entry.oracle_sql()[name])
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["store_name", "year", "quarter", "total_quarterly_sales"]
    assert df.count() > 0


def test_invariants(spark):
    q = entry.queries()
    fact_total = q["build_fact"](spark, SMOKE_DIR).agg(F.sum("total_sale")).first()[0]
    grand = q["q7"](spark, SMOKE_DIR).where("grouping_id = 15").collect()
    assert len(grand) == 1 and grand[0].yearly_revenue == fact_total
    halves = q["q8"](spark, SMOKE_DIR)
    per_product = halves.groupBy("product_name", "yearly_revenue").agg(F.sum("revenue_per_half").alias("s"))
    assert per_product.where("s <> yearly_revenue").count() == 0
    first_quarters = q["q2"](spark, SMOKE_DIR).groupBy("store_name").agg(
        F.min_by("growth_rate", "quarter").alias("g"))
    assert first_quarters.where(F.col("g").isNotNull()).count() == 0
    assert q["q6"](spark, SMOKE_DIR).count() == 0
    assert q["check_primary_keys"](spark, SMOKE_DIR).where("duplicate_keys > 0").count() == 0
    assert q["check_foreign_keys"](spark, SMOKE_DIR).where("orphan_rows > 0").count() == 0


def test_join_forms_equal_window_forms(spark):
    """J12 / J13 as written in the original queries give the same rows as the
    window forms used by default."""
    from starling.operators import olap
    from starling.plans import build as P
    wh = P.warehouse(spark, SMOKE_DIR)
    for fn, kw in [(olap.q5, {"previous": "self_join"}), (olap.q8, {"totals": "join"}),
                   (olap.q9, {"mean": "join"})]:
        assert sorted(fn(wh, **kw).collect()) == sorted(fn(wh).collect()), fn.__name__


def test_sql_over_registered_views(spark):
    """SQL written against the warehouse's table names runs on the views."""
    from starling.plans import build as P
    wh = P.warehouse(spark, SMOKE_DIR)
    assert "output_data" in wh.register_views()
    by_sql = spark.sql("""
        SELECT Gender AS gender, Store_Name AS store_name, count(DISTINCT Customer_ID) AS customers
        FROM sales JOIN customer USING (Customer_ID) JOIN store USING (Store_ID) GROUP BY ALL""")
    rows = {}
    for r in wh.table("staging").collect():
        rows.setdefault((r.gender, r.store_name), set()).add(r.customer_id)
    assert {(r.gender, r.store_name): r.customers for r in by_sql.collect()} == {k: len(v) for k, v in rows.items()}
