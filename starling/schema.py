"""Explicit schemas of every table (K0).  Nothing is inferred.

Ids are ``long``: the warehouse DDL says INT, but the test tables carry
bigint keys and a 100 TB feed overflows 32-bit order ids.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
MONEY_SUM = T.DecimalType(38, 2)
RATIO = T.DecimalType(38, 6)

# ---------------------------------------------------------------- transaction feed
# Positional layout.  The first five columns are the feed of the warehouse:
# order id, order date, product id, quantity, customer id.  ``supplier_id`` and
# ``line_number`` are optional trailing columns: the supplier rides on the line
# in the test tables, and the line number orders lines within an order.
FEED_COLUMNS = ["order_id", "order_date", "product_id", "quantity", "customer_id",
                "supplier_id", "line_number"]
FEED_BASE_COLUMNS = FEED_COLUMNS[:5]

# Place of a line in the feed: files by modification time, then path; in a file by
# block and row.  Batch and stream use the same order.
ARRIVAL = "arrival"

FEED_TEXT = T.StructType([T.StructField(c, T.StringType(), True) for c in FEED_COLUMNS])

FEED = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("order_date", T.TimestampNTZType(), False),
    T.StructField("product_id", T.LongType(), False),
    T.StructField("quantity", T.IntegerType(), False),
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("supplier_id", T.LongType(), True),
    T.StructField("line_number", T.IntegerType(), True),
])

# ---------------------------------------------------------------- master data
CUSTOMER_MASTER = T.StructType([
    T.StructField("customer_id", T.LongType(), True),
    T.StructField("customer_name", T.StringType(), True),
    T.StructField("gender", T.StringType(), True),
])

# Product master of the warehouse: supplier and store are product attributes.
PRODUCT_MASTER = T.StructType([
    T.StructField("product_id", T.LongType(), True),
    T.StructField("product_name", T.StringType(), True),
    T.StructField("product_price", MONEY, True),
    T.StructField("supplier_id", T.LongType(), True),
    T.StructField("supplier_name", T.StringType(), True),
    T.StructField("store_id", T.LongType(), True),
    T.StructField("store_name", T.StringType(), True),
])

# ---------------------------------------------------------------- staging (output_data)
ENRICHED = T.StructType([
    T.StructField("order_id", T.LongType(), True),
    T.StructField("order_date", T.TimestampNTZType(), True),
    T.StructField("product_id", T.LongType(), True),
    T.StructField("quantity_ordered", T.IntegerType(), True),
    T.StructField("customer_id", T.LongType(), True),
    T.StructField("customer_name", T.StringType(), True),
    T.StructField("gender", T.StringType(), True),
    T.StructField("product_name", T.StringType(), True),
    T.StructField("product_price", MONEY, True),
    T.StructField("store_id", T.LongType(), True),
    T.StructField("store_name", T.StringType(), True),
    T.StructField("supplier_id", T.LongType(), True),
    T.StructField("supplier_name", T.StringType(), True),
    T.StructField("total_sale", MONEY, True),
])
ENRICHED_COLUMNS = [f.name for f in ENRICHED.fields]

# Header line of the enriched CSV file, in column order.
ENRICHED_HEADER = [
    "Order ID", "Order Date", "Product ID", "Quantity Ordered", "Customer ID",
    "Customer Name", "Gender", "Product Name", "Product Price", "Store ID",
    "Store Name", "Supplier ID", "Supplier Name", "Total Sale",
]
# Fixed value: any feed line starting with this text is a header line.
FEED_HEADER_PREFIX = "Order ID"
# Header line of the feed files this library writes, in column order.
FEED_HEADER = ["Order ID", "Order Date", "Product ID", "Quantity Ordered", "Customer ID", "Supplier ID", "Line Number"]
# Fixed value: text layout of order dates in the feed and the enriched file.
DATETIME_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"

# ---------------------------------------------------------------- dimensions and fact
TIME_DIM = T.StructType([
    T.StructField("date_id", T.IntegerType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("day", T.StringType(), False),
    T.StructField("month", T.StringType(), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("is_weekend", T.BooleanType(), True),
])
PRODUCT_DIM = T.StructType([
    T.StructField("product_id", T.LongType(), False),
    T.StructField("product_name", T.StringType(), True),
    T.StructField("product_price", MONEY, True),
])
CUSTOMER_DIM = T.StructType([
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("customer_name", T.StringType(), True),
    T.StructField("gender", T.StringType(), True),
])
STORE_DIM = T.StructType([
    T.StructField("store_id", T.LongType(), False),
    T.StructField("store_name", T.StringType(), True),
])
SUPPLIER_DIM = T.StructType([
    T.StructField("supplier_id", T.LongType(), False),
    T.StructField("supplier_name", T.StringType(), True),
])
SALES = T.StructType([
    T.StructField("transaction_id", T.LongType(), False),
    T.StructField("date_id", T.IntegerType(), True),
    T.StructField("product_id", T.LongType(), True),
    T.StructField("customer_id", T.LongType(), True),
    T.StructField("store_id", T.LongType(), True),
    T.StructField("supplier_id", T.LongType(), True),
    T.StructField("quantity", T.IntegerType(), True),
    T.StructField("total_sale", MONEY, True),
])

# Primary key of every warehouse table.
PRIMARY_KEYS = {
    "time_dim": "date_id",
    "product": "product_id",
    "customer": "customer_id",
    "store": "store_id",
    "supplier": "supplier_id",
    "sales": "transaction_id",
}
# Foreign keys of the fact: fact column -> dimension table.
FOREIGN_KEYS = {
    "date_id": "time_dim",
    "product_id": "product",
    "customer_id": "customer",
    "store_id": "store",
    "supplier_id": "supplier",
}


def conform(df, schema: T.StructType):
    """Select and cast ``df`` to ``schema`` (column order and types)."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
