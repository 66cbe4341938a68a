"""Plan properties that matter at scale: size-checked broadcasts, filters
reaching the scan, partial aggregation before shuffles."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from starling.operators import olap
from starling.operators.sizing import bounded_broadcast, table_size
from starling.plans import build as P
from tests.conftest import SMOKE_DIR, plan_text


def test_bounded_broadcast_only_within_budget(spark):
    df = spark.range(1000).select(F.col("id"), F.lit("x").alias("s"))
    size = table_size(df)
    assert size == (1000, 1000 * (16 + 8 + 1))                 # overhead + long + one byte of text
    assert "BroadcastExchange" in plan_text(spark.range(10).join(bounded_broadcast(df, size), "id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for side in (bounded_broadcast(df, size, max_bytes=size[1] - 1),   # over the budget
                     bounded_broadcast(df, size),                          # broadcasts turned off
                     bounded_broadcast(df, None, max_bytes=1 << 30)):      # never measured
            assert "BroadcastExchange" not in plan_text(spark.range(10).join(side, "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_long_strings_count_by_their_length(spark):
    """100 rows of 200 kB text: few rows, but far over a 10 MB budget."""
    wide = spark.range(100).select("id", F.repeat(F.lit("x"), 200_000).alias("s"))
    rows, size = table_size(wide)
    assert rows == 100 and size > 10 * 1024 * 1024


def test_year_filter_reaches_fact_scan(spark):
    wh = P.warehouse(spark, SMOKE_DIR)
    text = plan_text(olap.q1(wh, 1997))
    assert "GreaterThanOrEqual(date_id,19970101)" in text and "LessThanOrEqual(date_id,19971231)" in text
    assert "TakeOrderedAndProject" in text


def _plan_without_broadcasts(spark, make):
    """The physical plan as at scale: no broadcast of a growing dimension, no adaptive change."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return make()._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_q1_aggregates_before_joining_names(spark):
    details = plan_text(olap.q1(P.warehouse(spark, SMOKE_DIR)))
    details = details[details.index("\n(1) "):]
    assert details.index("partial_sum") < details.index("product_name")


def test_q3_and_q7_shuffle_the_fact_once_per_growing_dimension(spark):
    """Store and time are bounded; supplier and product are met in their buckets, and
    one more shuffle groups by name."""
    wh = P.warehouse(spark, SMOKE_DIR)
    for query, extra in ((olap.q3, 0), (olap.q7, 1)):  # the rollup adds up the finest level
        text = _plan_without_broadcasts(spark, lambda q=query: q(_Bounded(wh)))
        shuffles = re.findall(r"Exchange hashpartitioning\((\w+)", text)
        assert [x.split("#")[0] for x in shuffles].count("supplier_id") == 1
        assert [x.split("#")[0] for x in shuffles].count("product_id") == 1
        assert len(shuffles) == 3 + extra


class _Bounded:
    """The warehouse with its calendar and stores broadcast, as their sizes allow at any scale."""

    def __init__(self, wh):
        self.wh = wh

    def table(self, name):
        return self.wh.table(name)

    def dim(self, name):
        df = self.wh.table(name)
        return F.broadcast(df) if name in ("time_dim", "store") else df


def test_q3_reads_four_fact_columns(spark):
    text = plan_text(olap.q3(P.warehouse(spark, SMOKE_DIR)))
    assert "ReadSchema: struct<product_id:bigint,store_id:bigint,supplier_id:bigint,total_sale:decimal(10,2)>" in text


def test_q6_names_come_after_the_limit(spark):
    text = plan_text(olap.q6(P.warehouse(spark, SMOKE_DIR)))
    details = text[text.index("\n(1) "):]
    assert details.index("TakeOrderedAndProject") < details.rindex("product2_name")
    joined = [m.start() for m in re.finditer(r"BroadcastHashJoin|SortMergeJoin", details)]
    limit = details.index("TakeOrderedAndProject")
    assert sum(j > limit for j in joined) >= 2


def test_a_dimension_is_written_after_one_shuffle(spark):
    from starling.operators.warehouse import _DIMENSION_ROWS
    staging = P.warehouse(spark, SMOKE_DIR).table("staging")
    for name, (rows, _) in _DIMENSION_ROWS.items():
        text = _plan_without_broadcasts(spark, lambda rows=rows: rows(staging))
        assert text.count("Exchange hashpartitioning") == 1, name


def test_top_k_per_group_limits_before_shuffle(spark):
    wh = P.warehouse(spark, SMOKE_DIR)
    assert "WindowGroupLimit" in plan_text(olap.q1_top5_each(wh))


def test_budget_follows_session_threshold(spark):
    from starling.operators.sizing import broadcast_budget, parse_bytes
    assert [parse_bytes(x) for x in ["10485760b", "10MB", "64m", "1g", "-1"]] == \
        [10485760, 10485760, 64 << 20, 1 << 30, -1]
    assert broadcast_budget(spark) == 10 * 1024 * 1024
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert broadcast_budget(spark) == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_warehouse_records_measured_sizes(spark):
    wh = P.warehouse(spark, SMOKE_DIR)
    rows, size = wh.sizes["time_dim"]
    assert rows == wh.table("time_dim").count() and size > rows * 16
    assert "BroadcastExchange" in plan_text(wh.table("sales").join(wh.dim("time_dim"), "date_id"))


def test_bucketed_dimensions_are_not_shuffled(spark):
    """With broadcasts off (the 100 TB case), a name join shuffles only the
    aggregated side: each dimension key is exchanged once, not twice."""
    import contextlib
    import io
    wh = P.warehouse(spark, SMOKE_DIR)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            olap.q3(wh).explain()
        text = buf.getvalue()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert text.count("Bucketed: true") == 2
    assert text.count("Exchange hashpartitioning(product_id") == 1
    assert text.count("Exchange hashpartitioning(supplier_id") == 1
