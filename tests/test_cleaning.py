"""Typing and quarantine of the raw feed (FIXTURES: bad integer, short and
empty lines, bad date, money text, repeated header)."""

from __future__ import annotations

import os
from decimal import Decimal

from pyspark.sql import functions as F

from starling.functions import cleaning
from starling.sources import feed_csv


def _write(path, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.csv"), "w") as f:
        f.write(text)
    return path


HEADER = "Order ID,Order Date,Product ID,Quantity,Customer ID,Supplier ID,Line\n"


def test_bad_rows_go_to_quarantine(spark, tmp_dir):
    path = _write(tmp_dir + "/feed", HEADER + "\n".join([
        "1,2024-01-05 10:00:00,7,2,3,4,1",        # good
        "2,2024-01-05 10:00:00,7,x,3,4,1",        # bad integer
        "3,2024-01-05 10:00:00,7,2",              # short row
        "",                                       # blank: ignored
        "4,bad,7,2,3,4,1",                        # bad date
        "5,2024-01-05,7,2,3,4,1",                 # date without time
        HEADER.strip(),                           # repeated header
        "6,2024-1-5 09:30:00.250,7,+3,3,,",       # good: short month/day, fraction, no extras
    ]) + "\n")
    text = feed_csv.read_feed_text(spark, path)
    good = {r.order_id: r for r in feed_csv.clean_feed(text).collect()}
    bad = {r.order_id: r.reject_reason for r in feed_csv.quarantine(text).collect()}
    assert sorted(good) == [1, 6]
    assert good[6].quantity == 3 and good[6].supplier_id is None
    assert str(good[6].order_date) == "2024-01-05 09:30:00.250000"
    assert bad == {"2": "bad quantity", "3": "bad customer_id", "4": "bad order_date",
                   "5": "bad order_date"}  # the repeated header is no row at all
    assert feed_csv.header_lines(text).count() == 2


def test_strict_int_rejects_decimals_and_overflow(spark):
    df = spark.createDataFrame([("12",), (" 7 ",), ("1.5",), ("9999999999",), ("",), (None,)], "v string")
    out = [r.i for r in df.select(cleaning.strict_int("v").alias("i")).collect()]
    assert out == [12, 7, None, None, None, None]


def test_money_text(spark):
    df = spark.createDataFrame([("$1,299.99",), ("abc",), ("",), ("12",), ("99999999999",)], "v string")
    rows = df.select(cleaning.money("v").alias("m"), cleaning.money_is_defaulted("v").alias("d")).collect()
    assert [r.m for r in rows] == [Decimal("1299.99"), Decimal("0.00"), Decimal("0.00"),
                                   Decimal("12.00"), Decimal("0.00")]
    assert [r.d for r in rows] == [False, True, True, False, True]


def test_timestamp_needs_time_part(spark):
    df = spark.createDataFrame([("2024-02-29 23:59:59",), ("2024-02-30 10:00:00",), ("2024-02-29",)], "v string")
    out = [r.t for r in df.select(cleaning.strict_timestamp("v").alias("t")).collect()]
    assert out[0] is not None and out[1] is None and out[2] is None
    assert df.select(F.count_if(cleaning.strict_timestamp("v").isNull())).first()[0] == 2


def test_master_csv_with_crlf_and_quotes(spark, tmp_dir):
    from starling.schema import PRODUCT_MASTER
    from starling.sources.tables import read_master_csv
    os.makedirs(tmp_dir + "/m", exist_ok=True)
    with open(tmp_dir + "/m/product_master.csv", "wb") as f:
        f.write(b"productID,productName,productPrice,supplierID,supplierName,storeID,storeName\r\n"
                b"1,Lamp,12.50,3,\"Acme, Inc.\",2,North\r\n"
                b"2,\"Desk \"\"Pro\"\"\",99.99,4,Zed,2,North\r\n")
    rows = read_master_csv(spark, tmp_dir + "/m", PRODUCT_MASTER).collect()
    assert [(r.product_id, r.product_name, r.supplier_name, r.store_name) for r in rows] == [
        (1, "Lamp", "Acme, Inc.", "North"), (2, 'Desk "Pro"', "Zed", "North")]
    assert rows[0].product_price == Decimal("12.50")
