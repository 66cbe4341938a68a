"""Loads in batches: equal to one load, replay-safe, with retractions and untouched periods."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starling.operators import incremental, olap
from starling.operators.incremental import IncrementalWarehouse
from starling.operators.warehouse import TableSet
from starling.schema import ENRICHED_COLUMNS
from starling.streaming.feed_stream import LOG_SCHEMA
from tests.conftest import staging_row

TABLES = ["staging", "sales", "time_dim", "product", "customer", "store", "supplier"]


def lines(spark, data):
    """Rows of (line number, staging row)."""
    return spark.createDataFrame([(*row, n, None) for n, row in data], LOG_SCHEMA)


def ordered(df, columns=None):
    cols = columns or sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def last_rows(data):
    """The winning staging row of every order."""
    out = {}
    for n, row in data:
        key = (n, row[2], row[11], row[3])
        if row[0] not in out or key > out[row[0]][0]:
            out[row[0]] = (key, row)
    return [row for _, row in out.values()]


def same_as_full(spark, make_staging, wh, data):
    full = TableSet.from_staging(make_staging(last_rows(data)))
    for name in TABLES:
        columns = sorted(full.table(name).columns)
        assert ordered(wh.table(name), columns) == ordered(full.table(name), columns), name
    want = ordered(olap.store_quarterly_sales(full))
    assert ordered(wh.store_quarterly_sales()) == want
    assert ordered(olap.store_quarterly_sales(wh)) == want


def random_line(rng, n):
    product = rng.randrange(6)
    return rng.randrange(1000), staging_row(
        rng.randrange(25), f"199{rng.randrange(7, 9)}-{rng.randrange(1, 13):02d}-0{rng.randrange(1, 4)} 00:00:00", product,
        rng.randrange(1, 9), rng.randrange(4), rng.randrange(3), rng.randrange(5), supplier_name=f"name {rng.randrange(3)}")


@pytest.mark.parametrize("max_pieces", [2, 16])
def test_batches_end_where_one_load_does(spark, tmp_dir, make_staging, max_pieces):
    rng, data = random.Random(7), []
    wh = IncrementalWarehouse(spark, tmp_dir + "/wh", max_pieces=max_pieces)
    for batch in range(3):
        part = [random_line(rng, batch) for _ in range(25)]
        data += part
        assert wh.load(lines(spark, part), batch)
        assert not wh.load(lines(spark, part), batch)
        if batch == 1:
            assert wh.compact() == 1
    same_as_full(spark, make_staging, wh, data)
    manifest = wh._manifest()
    assert all(len(p) <= max_pieces for p in [*manifest["views"].values(), *manifest["sales"].values()])
    wh.close()


def test_a_replaced_order_takes_its_rows_back(spark, tmp_dir):
    wh = IncrementalWarehouse(spark, tmp_dir + "/wh")
    wh.load(lines(spark, [(1, staging_row(1, "1997-01-05 00:00:00", product_id=7, store_id=1)),
                          (1, staging_row(2, "1997-01-06 00:00:00", product_id=8, store_id=1))]), 0)
    wh.load(lines(spark, [(2, staging_row(1, "1997-05-05 00:00:00", product_id=9, store_id=2, qty=3)),
                          (0, staging_row(2, "1997-09-09 00:00:00", product_id=6))]), 1)  # a late line that loses
    assert ordered(wh.table("product"), ["product_id"]) == [(8,), (9,)]
    assert ordered(wh.table("time_dim"), ["date_id"]) == [(19970106,), (19970505,)]
    assert [(r[0], r[2], r[3]) for r in wh.store_quarterly_sales().collect()] == [
        ("store 1", 1, Decimal("10.00")), ("store 2", 2, Decimal("30.00"))]
    assert ordered(wh.sales([199701]), ["transaction_id"]) == [(2,)]


def test_only_periods_with_replaced_rows_are_written_again(spark, tmp_dir):
    wh = IncrementalWarehouse(spark, tmp_dir + "/wh")
    wh.load(lines(spark, [(1, staging_row(m, f"1997-{m:02d}-05 00:00:00")) for m in (1, 2, 3)]), 0)
    before = wh._manifest()["sales"]
    wh.load(lines(spark, [(2, staging_row(1, "1997-01-07 00:00:00")), (1, staging_row(9, "1997-02-08 00:00:00"))]), 1)
    after = wh._manifest()["sales"]
    assert after["199703"] == before["199703"]                              # untouched
    assert after["199702"][:1] == before["199702"] and len(after["199702"]) == 2  # a new order: one more piece
    assert len(after["199701"]) == 1 and after["199701"] != before["199701"]      # a replaced one: written again


def test_a_load_that_dies_is_repeated_from_the_log(spark, tmp_dir, make_staging, monkeypatch):
    data = [(1, staging_row(1, "1997-01-05 00:00:00")), (1, staging_row(2, "1997-02-05 00:00:00", product_id=3))]
    more = [(2, staging_row(2, "1997-03-05 00:00:00", product_id=4))]
    wh = IncrementalWarehouse(spark, tmp_dir + "/wh")
    wh.load(lines(spark, data), 0)
    with monkeypatch.context() as m:
        m.setattr(IncrementalWarehouse, "_load_sales", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            wh.load(lines(spark, more), 1)
    same_as_full(spark, make_staging, wh, data)  # the version before
    assert wh.version() == 0
    assert wh.load(lines(spark, more), 1)        # the batch is in the log; the tables follow
    same_as_full(spark, make_staging, wh, data + more)


def test_a_conflicting_key_fails_the_load(spark, tmp_dir):
    wh = IncrementalWarehouse(spark, tmp_dir + "/wh")
    wh.load(lines(spark, [(1, staging_row(1, "1997-01-05 00:00:00", product_id=3, price="1.00"))]), 0)
    with pytest.raises(ValueError, match="1 keys of product"):
        wh.load(lines(spark, [(1, staging_row(2, "1997-01-05 00:00:00", product_id=3, price="2.00"))]), 1)
    assert wh.version() == 0 and wh.table("sales").count() == 1


def test_empty_batches_and_null_keys(spark, tmp_dir, make_staging):
    wh = IncrementalWarehouse(spark, tmp_dir + "/wh")
    assert wh.version() == -1 and wh.table("sales").count() == 0 and wh.store_quarterly_sales().count() == 0
    wh.load(lines(spark, []), 0)
    assert wh.version() == 0 and wh.table("product").count() == 0
    null_store = staging_row(1, "1997-01-05 00:00:00", store_id=None, store_name=None)
    wh.load(lines(spark, [(1, null_store)]), 1)
    assert wh.table("sales").count() == 0 and wh.store_quarterly_sales().count() == 0
    assert ordered(wh.table("staging"), ENRICHED_COLUMNS) == ordered(make_staging([null_store]), ENRICHED_COLUMNS)


def test_a_view_of_ones_own(spark, tmp_dir):
    by_day = incremental.GroupedView("by_product", ("product_id",), lambda rows: rows.select(
        incremental._SIGN, "product_id", "total_sale"), ("total_sale",))
    wh = IncrementalWarehouse(spark, tmp_dir + "/wh", views=[by_day])
    wh.load(lines(spark, [(1, staging_row(1, "1997-01-05 00:00:00", product_id=1)),
                          (1, staging_row(2, "1997-01-05 00:00:00", product_id=1))]), 0)
    wh.load(lines(spark, [(2, staging_row(2, "1997-01-05 00:00:00", product_id=2))]), 1)
    assert ordered(wh.view("by_product").withColumn("total_sale", F.col("total_sale").cast("string"))) == [
        (1, 1, "10.00"), (2, 1, "10.00")]
