"""Table sinks and scans.

Tables are Parquet folders.  ``load_table`` can also append over JDBC when a
URL is given (the batched insert of the original loader); that path needs a
database the whole cluster can reach and is not exercised by the tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from starling.functions import cleaning

PRICE = "product_price"


def write_table(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def load_table(df: DataFrame, path: str | None = None, *, jdbc_url: str | None = None,
               table: str | None = None, batchsize: int = 10_000,
               properties: dict | None = None) -> None:
    """Bulk load: Parquet by default, JDBC append with batched inserts when asked."""
    if jdbc_url:
        writer = (df.write.format("jdbc").option("url", jdbc_url).option("dbtable", table)
                  .option("batchsize", batchsize))
        for k, v in (properties or {}).items():
            writer = writer.option(k, v)
        writer.mode("append").save()
    else:
        write_table(df, path)


def read_master(spark: SparkSession, path: str, columns: list[str], fmt: str = "parquet",
                schema=None, **options) -> DataFrame:
    """Scan a master table and keep only ``columns`` (pruned at the scan)."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path).select(*columns)


# CSV dialect of master files: header line, comma, double quote doubled as
# escape, CRLF or LF line ends, fields trimmed.
MASTER_CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "mode": "FAILFAST",
    "enforceSchema": "true",
}


def _price_as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType() if f.name == PRICE else f.dataType, f.nullable)
                         for f in schema.fields])


def _master_text(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(_price_as_text(schema)).options(**MASTER_CSV_OPTIONS).csv(path)


def read_master_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Scan a master CSV file by position with an explicit schema.

    A malformed id fails the job (``FAILFAST``): a half-read master would
    silently drop every transaction that needs the missing rows.  A price is
    read tolerantly (``$1,299.99``; junk is 0.00), see :func:`defaulted_prices`.
    """
    return _master_text(spark, path, schema).select(
        *[(cleaning.money(f.name) if f.name == PRICE else F.col(f.name)).alias(f.name) for f in schema.fields])


def defaulted_prices(spark: SparkSession, path: str, schema) -> DataFrame:
    """The master rows whose price text is no amount and was read as 0.00."""
    return _master_text(spark, path, schema).where(cleaning.money_is_defaulted(PRICE))
