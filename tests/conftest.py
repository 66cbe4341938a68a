from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)


def ts(s: str) -> dt.datetime:
    return dt.datetime.strptime(s, "%Y-%m-%d %H:%M:%S")


AUTO = object()  # default name derived from the id; pass None for a real NULL


def staging_row(order_id, date, product_id=1, qty=1, customer_id=1, store_id=1, supplier_id=1,
                price="10.00", product_name=AUTO, store_name=AUTO, supplier_name=AUTO,
                customer_name="Ann", gender="F"):
    price = Decimal(price)
    pick = lambda v, default: default if v is AUTO else v
    return (order_id, ts(date), product_id, qty, customer_id, customer_name, gender,
            pick(product_name, f"product {product_id}"), price, store_id,
            pick(store_name, f"store {store_id}"), supplier_id,
            pick(supplier_name, f"supplier {supplier_id}"), (price * qty).quantize(Decimal("0.01")))


@pytest.fixture
def make_staging(spark):
    from starling.schema import ENRICHED

    def make(rows):
        return spark.createDataFrame(rows, ENRICHED)
    return make


def plan_text(df) -> str:
    """The formatted physical plan of ``df``, as ``explain`` prints it."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()
