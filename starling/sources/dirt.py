"""Dirt made by formula, for exercising the cleaning and matching operators.

The test tables are clean, so the operators that deal with dirty input need
dirt.  It is made in memory from every row (the files are read-only), and the
oracle SQL makes the same dirt with the same formulas.  The rules mark rows
(a bad quantity, a junk price, a second supplier name); every row is still
processed.  Unmatched transactions come from a business rule instead: closed
accounts (negative balance) are not in the customer master.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starling.sources.testdata import read_table

# The dirt formulas.
BAD_QUANTITY_EVERY = 97      # order ids divisible by this get quantity text 'x'
BAD_PRICE_EVERY = 97         # part keys divisible by this get price text 'abc'
EMPTY_PRICE_EVERY = 89       # part keys divisible by this get empty price text
SECOND_NAME_EVERY = 10       # suppliers divisible by this get a second name
SECOND_NAME_PREFIX = "Alt "


def feed_text_with_bad_quantity(feed_text: DataFrame) -> DataFrame:
    return feed_text.withColumn(
        "quantity",
        F.when(F.col("order_id").cast("long") % BAD_QUANTITY_EVERY == 0, F.lit("x"))
        .otherwise(F.col("quantity")))


def price_text(products: DataFrame) -> DataFrame:
    """``product_id, price_text``: ``$`` and the price, or junk."""
    return products.select(
        "product_id",
        F.when(F.col("product_id") % BAD_PRICE_EVERY == 0, F.lit("abc"))
        .when(F.col("product_id") % EMPTY_PRICE_EVERY == 0, F.lit(""))
        .otherwise(F.concat(F.lit("$"), F.col("product_price").cast("string")))
        .alias("price_text"))


def open_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer master without closed accounts (negative balance): the
    feed still holds their orders, which then find no customer."""
    return (read_table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0)
            .select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
                    F.col("c_mktsegment").alias("gender")))


def suppliers_with_second_names(suppliers: DataFrame) -> DataFrame:
    extra = (suppliers.where(F.col("supplier_id") % SECOND_NAME_EVERY == 0)
             .withColumn("supplier_name", F.concat(F.lit(SECOND_NAME_PREFIX), F.col("supplier_name"))))
    return suppliers.unionByName(extra)
