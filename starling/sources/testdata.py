"""Mapping of the driver's test tables onto the warehouse roles.

| role        | test table(s)                                               |
|-------------|-------------------------------------------------------------|
| feed line   | ``lineitem``: order, product, supplier, quantity, line no.  |
| feed header | ``orders``: order date and customer of each order           |
| customer    | ``customer``; the market segment stands in for gender       |
| product     | ``part``; retail price as ``decimal(10,2)``                 |
| supplier    | ``supplier``; its nation is the store the line is sold in   |
| store       | ``nation``                                                  |

Unlike the warehouse's own product master, the supplier rides on the line
here, not on the product.  Every reader selects only the columns it needs, so
the Parquet scan prunes the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starling.schema import DATETIME_TEXT_FORMAT, FEED_COLUMNS

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def feed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-level part of the feed: one row per ``lineitem`` row."""
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_linenumber").alias("line_number"),
    )


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-level part of the feed: date and customer, one row per order."""
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("order_date"),
        F.col("o_custkey").alias("customer_id"),
    )


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed transaction feed: every line with its order's date and customer."""
    return feed_lines(spark, sf_dir).join(order_headers(spark, sf_dir), "order_id").select(*FEED_COLUMNS)


def _as_text(f: DataFrame) -> DataFrame:
    return f.select(
        F.col("order_id").cast("string").alias("order_id"),
        F.date_format("order_date", DATETIME_TEXT_FORMAT).alias("order_date"),
        *[F.col(c).cast("string").alias(c) for c in FEED_COLUMNS[2:]],
    )


def feed_text(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """The feed as the text a CSV file carries (all columns strings).

    With ``parts``, the lines of an order are dealt out over that many partitions,
    by hash and as numbers: nothing is sorted for it, and the text is made last.
    """
    rows = feed(spark, sf_dir)
    return _as_text(rows if parts is None else rows.repartition(parts, *FEED_COLUMNS))


def customer_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("gender"),
    )


def product_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("product_price"),
    )


def supplier_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("supplier_id"),
        F.col("s_name").alias("supplier_name"),
        F.col("s_nationkey").cast("long").alias("store_id"),
    )


def store_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("long").alias("store_id"),
        F.col("n_name").alias("store_name"),
    )


def product_master_with_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product master in the warehouse's own seven columns: the least supplier
    that a part's lines name, and that supplier's nation as the store."""
    least = read_table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("product_id")).agg(
        F.min("l_suppkey").alias("supplier_id"))
    return (product_master(spark, sf_dir).join(least, "product_id")
            .join(supplier_master(spark, sf_dir), "supplier_id").join(store_master(spark, sf_dir), "store_id")
            .select("product_id", "product_name", "product_price", "supplier_id", "supplier_name",
                    "store_id", "store_name"))


def five_column_feed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed in the warehouse's own five columns (no supplier, no line number),
    an order's lines one after the other in line order (ties by product, supplier, quantity).

    The lines are dealt out by order once: the join with the headers and the
    order within a partition use it, on numbers; the text is made last.
    """
    rows = feed_lines(spark, sf_dir).repartition("order_id").join(order_headers(spark, sf_dir), "order_id").select(
        *FEED_COLUMNS).sortWithinPartitions("order_id", "line_number", "product_id", "supplier_id", "quantity")
    return _as_text(rows).withColumns({c: F.lit(None).cast("string") for c in FEED_COLUMNS[5:]})
