"""The whole warehouse from files in the original layout (CSV feed without a
sequence column, CSV masters with supplier and store on the product)."""

from __future__ import annotations

import os
from decimal import Decimal

from starling.operators import olap
from starling.plans import files


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.replace("\n", "\r\n").encode())


def test_warehouse_from_original_layout(spark, tmp_dir):
    _write(tmp_dir + "/masters/customer_master.csv",
           "customer_id,customer_name,gender\n1,Ann,Female\n2,Bob,Male\n")
    _write(tmp_dir + "/products/product_master.csv",
           "productID,productName,productPrice,supplierID,supplierName,storeID,storeName\n"
           "10,Lamp,12.50,5,\"Acme, Inc.\",1,North\n"
           "11,Desk,100.00,6,Zed,2,South\n"
           "11,Desk copy,1.00,6,Zed,2,South\n")          # duplicate id: first in stated order wins
    _write(tmp_dir + "/feed/transactions.csv",
           "Order ID,Order Date,Product ID,Quantity Ordered,Customer ID\n"
           "1,2019-03-02 10:00:00,10,2,1\n"              # Saturday
           "1,2019-03-02 10:05:00,11,1,1\n"              # later line of order 1 wins
           "2,2019-07-01 09:00:00,10,4,2\n"
           "2,2019-07-01 09:30:00,77,1,2\n"              # unknown product: does not replace
           "3,2019-07-02 09:00:00,11,1,9\n"              # unknown customer: dropped
           "4,x,10,1,1\n")                               # bad date: quarantined
    wh = files.warehouse_from_files(spark, tmp_dir + "/feed", tmp_dir + "/masters",
                                    tmp_dir + "/products", root=tmp_dir + "/wh")
    staging = {r.order_id: (r.product_id, r.product_name, r.total_sale, r.supplier_name)
               for r in wh.table("staging").collect()}
    assert staging == {1: (11, "Desk", Decimal("100.00"), "Zed"),
                       2: (10, "Lamp", Decimal("50.00"), "Acme, Inc.")}
    q10 = [(r.store_name, r.year, r.quarter, r.total_quarterly_sales) for r in olap.q10(wh).collect()]
    assert q10 == [("North", 2019, 3, Decimal("50.00")), ("South", 2019, 1, Decimal("100.00"))]
    weekend = {r.date.isoformat(): r.is_weekend for r in wh.table("time_dim").collect()}
    assert weekend == {"2019-03-02": True, "2019-07-01": False}
    _, bad = files.typed_feed(spark, tmp_dir + "/feed")
    assert [r.order_id for r in bad.collect()] == ["4"]


def test_later_file_wins(spark, tmp_dir):
    _write(tmp_dir + "/c/customer_master.csv", "customer_id,customer_name,gender\n1,Ann,Female\n")
    _write(tmp_dir + "/p/product_master.csv",
           "productID,productName,productPrice,supplierID,supplierName,storeID,storeName\n"
           "10,Lamp,1.00,5,S,1,North\n11,Desk,2.00,5,S,1,North\n12,Sofa,3.00,5,S,1,North\n")
    header = "Order ID,Order Date,Product ID,Quantity Ordered,Customer ID\n"
    _write(tmp_dir + "/f/part-1.csv", header + "1,2019-01-01 10:00:00,10,1,1\n1,2019-01-01 10:00:00,12,1,1\n")
    _write(tmp_dir + "/f/part-2.csv", header + "1,2019-01-01 11:00:00,11,1,1\n")
    stg = files.staging_from_files(spark, tmp_dir + "/f", tmp_dir + "/c", tmp_dir + "/p").collect()
    assert [(r.order_id, r.product_name) for r in stg] == [(1, "Desk")]


def test_master_prices_are_read_tolerantly(spark, tmp_dir):
    import pytest
    from starling.schema import PRODUCT_MASTER
    from starling.sources import tables
    header = "productID,productName,productPrice,supplierID,supplierName,storeID,storeName\n"
    _write(tmp_dir + "/p/p.csv", header + "1,A,\"$1,299.99\",5,S,1,N\n2,B,null,5,S,1,N\n3,C,abc,5,S,1,N\n4,D,2.50,5,S,1,N\n")
    got = {r.product_id: r.product_price for r in tables.read_master_csv(spark, tmp_dir + "/p", PRODUCT_MASTER).collect()}
    assert got == {1: Decimal("1299.99"), 2: Decimal("0.00"), 3: Decimal("0.00"), 4: Decimal("2.50")}
    bad = tables.defaulted_prices(spark, tmp_dir + "/p", PRODUCT_MASTER).collect()
    assert sorted((r.product_id, r.product_price) for r in bad) == [(2, "null"), (3, "abc")]
    _write(tmp_dir + "/q/p.csv", header + "x,A,1.00,5,S,1,N\n")
    with pytest.raises(Exception):  # a bad id fails the job
        tables.read_master_csv(spark, tmp_dir + "/q", PRODUCT_MASTER).collect()


def test_a_changed_source_is_built_anew(spark, tmp_dir):
    import shutil

    import pyarrow.parquet as pq
    from starling.plans import build as P
    from tests.conftest import SMOKE_DIR
    for t in P.SOURCE_TABLES:
        shutil.copyfile(f"{SMOKE_DIR}/{t}.parquet", f"{tmp_dir}/{t}.parquet")
    first = P.warehouse(spark, tmp_dir)
    assert P.warehouse(spark, tmp_dir) is first
    lines = pq.read_table(f"{SMOKE_DIR}/lineitem.parquet")
    pq.write_table(lines.slice(0, lines.num_rows // 2), f"{tmp_dir}/lineitem.parquet")
    second = P.warehouse(spark, tmp_dir)
    assert second is not first
    assert 0 < second.table("sales").count() < first.table("sales").count()


def test_a_cluster_must_name_its_shared_folder(monkeypatch):
    import pytest
    from starling import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

        class sparkContext:  # noqa: N801
            applicationId = "app"

            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())
