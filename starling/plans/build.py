"""End-to-end plans over the driver's test tables.

The warehouse (staging, dimensions, fact) is written once per session and
snapshot of the source folder (its files, their sizes and modification times)
and reused by every query; CSV feeds written for the source operators are
reused the same way.  A changed source is built anew.  Everything is written
below the session's checkpoint folder.
"""

from __future__ import annotations

import math
import threading

from pyspark.sql import DataFrame, SparkSession, functions as F

from starling.operators import enrich as E
from starling.operators.incremental import IncrementalWarehouse
from starling.operators.surrogate import KeyMap
from starling.operators.warehouse import Warehouse
from starling.schema import ARRIVAL
from starling.session import app_id, scratch_dir
from starling.sources import dirt, feed_csv, testdata
from starling.streaming.feed_stream import ARRIVAL_TYPE

_LOCK = threading.RLock()
_CACHE: dict[tuple, object] = {}


SOURCE_TABLES = ("nation", "customer", "supplier", "part", "orders", "lineitem")


def snapshot(spark: SparkSession, sf_dir: str) -> tuple:
    """Path, size and modification time of every file of the source tables, as the file system of the path names them."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    out = []
    for name in SOURCE_TABLES:
        path = hadoop(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(path):
            files = [path] if fs.getFileStatus(path).isFile() else [x.getPath() for x in fs.listStatus(path)]
            for f in files:
                status = fs.getFileStatus(f)
                out.append((f.toString(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(out))


def _key(spark: SparkSession, sf_dir: str, what: str) -> tuple:
    return (app_id(spark), sf_dir.rstrip("/"), snapshot(spark, sf_dir), what)


def cached(spark: SparkSession, sf_dir: str, what: str, make):
    """``make()`` once per session, snapshot of the source folder and ``what``."""
    key = _key(spark, sf_dir, what)
    with _LOCK:
        if key not in _CACHE:
            _CACHE[key] = make()
        return _CACHE[key]


class Masters:
    """The four masters of the test tables, in the warehouse's column names."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.customers = testdata.customer_master(spark, sf_dir)
        self.products = testdata.product_master(spark, sf_dir)
        self.suppliers = testdata.supplier_master(spark, sf_dir)
        self.stores = testdata.store_master(spark, sf_dir)


def lookups(spark: SparkSession, sf_dir: str) -> E.Lookups:
    """The masters as join sides."""
    m = Masters(spark, sf_dir)
    return E.prepare(m.customers, m.products, m.suppliers, m.stores)


def enriched_lines(spark: SparkSession, sf_dir: str, keep_order_columns: bool = False) -> DataFrame:
    """Every matched feed line with its 14 columns."""
    return E.enrich_parts(testdata.feed_lines(spark, sf_dir), testdata.order_headers(spark, sf_dir),
                          lookups(spark, sf_dir), keep_order_columns)


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging table: last matched line per order (keep-last before the
    order-level joins, see ``staging_from_parts``)."""
    return E.staging_from_parts(testdata.feed_lines(spark, sf_dir), testdata.order_headers(spark, sf_dir),
                                lookups=lookups(spark, sf_dir))


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return cached(spark, sf_dir, "warehouse", lambda: Warehouse.build(spark, staging(spark, sf_dir)))


def feed_csv_dir(spark: SparkSession, sf_dir: str, dirty: bool = False) -> str:
    """The feed of the test tables written as CSV, a file per partition (once per session and snapshot)."""
    def make():
        text = testdata.feed_text(spark, sf_dir)
        if dirty:
            text = dirt.feed_text_with_bad_quantity(text)
        return feed_csv.write_feed_csv(text, scratch_dir(spark, "feed-dirty" if dirty else "feed"))
    return cached(spark, sf_dir, f"feed-csv-{dirty}", make)


LOAD_BATCHES = 3


def load_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The enriched lines in ``LOAD_BATCHES`` batches that cut across orders: later batches
    replace rows of earlier ones, and some of their lines lose to an earlier one.

    The lines are written once: the joins with headers and customers, and the deal by order, are done once, not by batch.
    """
    def make():
        lines = enriched_lines(spark, sf_dir, keep_order_columns=True).withColumn(ARRIVAL, F.lit(None).cast(ARRIVAL_TYPE))
        path = scratch_dir(spark, "load-batches")
        lines.write.parquet(path)
        return path, lines.schema
    path, schema = cached(spark, sf_dir, "load-batches", make)
    lines = spark.read.schema(schema).parquet(path)
    return [lines.where(F.pmod("line_number", F.lit(LOAD_BATCHES)) == k) for k in range(LOAD_BATCHES)]


def incremental_warehouse(spark: SparkSession, sf_dir: str) -> IncrementalWarehouse:
    """A warehouse loaded batch by batch; the last batch is loaded twice, the log is compacted before it."""
    def make():
        wh = IncrementalWarehouse(spark, scratch_dir(spark, "incremental"))
        *first, last = load_batches(spark, sf_dir)
        for k, batch in enumerate(first):
            wh.load(batch, k, dealt=True)
        wh.compact()
        for _ in range(2):
            wh.load(last, len(first), dealt=True)
        return wh
    return cached(spark, sf_dir, "incremental", make)


def key_map(spark: SparkSession, sf_dir: str, column: str) -> KeyMap:
    """The numbers of a column of the enriched lines, given batch by batch; the last batch is loaded twice."""
    def make():
        batches = load_batches(spark, sf_dir)
        numbers = KeyMap(spark, scratch_dir(spark, "key-map"), column, batches[0].schema[column].dataType, "key")
        for k, batch in enumerate([*batches, batches[-1]]):
            numbers.load(batch, min(k, len(batches) - 1))
        return numbers
    return cached(spark, sf_dir, f"key-map-{column}", make)


FEED_PARTS = 8
FEED_PART_BYTES = 32 << 20  # of ``lineitem`` files, for each file of the feed


def feed_parts(spark: SparkSession, sf_dir: str) -> int:
    """Files of the feed in parts: ``FEED_PARTS``, and as many times that as the lines need for tasks of an even size."""
    size = sum(n for path, n, _ in snapshot(spark, sf_dir) if "/lineitem.parquet" in path)
    return FEED_PARTS * max(1, math.ceil(size / (FEED_PARTS * FEED_PART_BYTES)))


def feed_in_parts_dir(spark: SparkSession, sf_dir: str) -> str:
    """The feed of the test tables written as ``feed_parts`` CSV files, for streams of several micro-batches."""
    return cached(spark, sf_dir, "feed-parts", lambda: feed_csv.write_feed_csv(
        testdata.feed_text(spark, sf_dir, feed_parts(spark, sf_dir)), scratch_dir(spark, "feed-parts")))


def delivered_again_dir(spark: SparkSession, sf_dir: str) -> str:
    """The files of ``feed_in_parts_dir`` delivered a second time: equal lines, other names."""
    def make():
        lines = spark.read.text(feed_in_parts_dir(spark, sf_dir)).select(
            "value", F.regexp_extract("_metadata.file_name", "^part-([0-9]+)", 1).alias("file"))
        out = scratch_dir(spark, "feed-again")
        lines.repartition("file").write.partitionBy("file").text(out)
        return out
    return cached(spark, sf_dir, "feed-again", make)


def five_column_feed_dir(spark: SparkSession, sf_dir: str) -> str:
    """The feed in the warehouse's own five columns, written as CSV."""
    return cached(spark, sf_dir, "feed-five", lambda: feed_csv.write_feed_csv(
        testdata.five_column_feed_text(spark, sf_dir), scratch_dir(spark, "feed-five")))


def product_lookups(spark: SparkSession, sf_dir: str) -> E.Lookups:
    """Customers, and products that carry their supplier and store."""
    return E.prepare(testdata.customer_master(spark, sf_dir), testdata.product_master_with_supplier(spark, sf_dir))
