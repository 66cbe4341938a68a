"""The warehouse from files in the original layout: a CSV transaction feed
(order id, order date, product id, quantity, customer id) and CSV masters
(customers: id, name, gender; products: id, name, price, supplier id and
name, store id and name).

Without a sequence column, the last line of an order is the last to
arrive (``arrival``, taken at the scan): files by modification time, then path;
in a file by block and row.  A stream over the same folder uses the same order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starling.operators import enrich as E
from starling.operators.warehouse import Warehouse
from starling.schema import CUSTOMER_MASTER, PRODUCT_MASTER
from starling.sources import feed_csv, tables


def read_masters(spark: SparkSession, customers_path: str, products_path: str) -> tuple[DataFrame, DataFrame]:
    return (tables.read_master_csv(spark, customers_path, CUSTOMER_MASTER),
            tables.read_master_csv(spark, products_path, PRODUCT_MASTER))


def typed_feed(spark: SparkSession, feed_dir: str) -> tuple[DataFrame, DataFrame]:
    """(good typed rows with their arrival, quarantined rows)."""
    text = feed_csv.read_feed_text(spark, feed_dir)
    return feed_csv.clean_feed(text), feed_csv.quarantine(text)


def staging_from_files(spark: SparkSession, feed_dir: str, customers_path: str,
                       products_path: str) -> DataFrame:
    """Staging rows: the last matched line of every order, enriched."""
    customers, products = read_masters(spark, customers_path, products_path)
    good, _ = typed_feed(spark, feed_dir)
    return E.latest_lines(good, E.prepare(customers, products))


def warehouse_from_files(spark: SparkSession, feed_dir: str, customers_path: str, products_path: str,
                         root: str | None = None) -> Warehouse:
    """Staging, dimensions and fact written once; query it with ``starling.operators.olap``."""
    return Warehouse.build(spark, staging_from_files(spark, feed_dir, customers_path, products_path),
                           root=root)
