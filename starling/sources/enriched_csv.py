"""Enriched CSV file: write it, scan it back typed.

A field is quoted only when it holds the delimiter, a quote or a line break;
quotes inside are doubled.  Dates are written as ``yyyy-MM-dd HH:mm:ss``.
An empty text is written as ``""`` so that it reads back as empty text; an
unquoted empty field also reads back as empty text, while a line that lacks
its last field is rejected (a short row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from starling.functions import cleaning
from starling.schema import DATETIME_TEXT_FORMAT, ENRICHED, ENRICHED_COLUMNS, ENRICHED_HEADER

WRITE_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": DATETIME_TEXT_FORMAT,
}
READ_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "mode": "PERMISSIVE",
    "enforceSchema": "true",
    "nullValue": "\u0000",
}
ENRICHED_TEXT = T.StructType([T.StructField(c, T.StringType(), True) for c in ENRICHED_COLUMNS])


def write_enriched_csv(df: DataFrame, path: str) -> str:
    """Write the 14 staging columns with the display header."""
    out = df.select(*[F.col(c).alias(h) for c, h in zip(ENRICHED_COLUMNS, ENRICHED_HEADER)])
    out.write.mode("overwrite").options(**WRITE_OPTIONS).csv(path)
    return path


def read_enriched_lines(spark: SparkSession, path: str) -> DataFrame:
    """The data lines of the file as written (header lines dropped)."""
    header = ",".join(ENRICHED_HEADER)
    return spark.read.text(path).where(F.col("value") != header).select(F.col("value").alias("line"))


def type_enriched(text: DataFrame) -> DataFrame:
    """Typed staging rows plus ``reject_reason``: ids strict, date strict, money tolerant."""
    typed = {}
    for f in ENRICHED.fields:
        if isinstance(f.dataType, T.LongType):
            typed[f.name] = cleaning.strict_long(f.name)
        elif isinstance(f.dataType, T.IntegerType):
            typed[f.name] = cleaning.strict_int(f.name)
        elif isinstance(f.dataType, T.TimestampNTZType):
            typed[f.name] = cleaning.strict_timestamp(f.name)
        elif isinstance(f.dataType, T.DecimalType):
            typed[f.name] = cleaning.money(f.name)
        else:
            typed[f.name] = F.coalesce(F.trim(F.col(f.name)), F.lit(""))
    last = ENRICHED_COLUMNS[-1]
    reason = F.when(F.col(last).isNull(), F.lit("short row"))
    for f in ENRICHED.fields:
        if isinstance(f.dataType, (T.LongType, T.IntegerType, T.TimestampNTZType)):
            reason = reason.when(typed[f.name].isNull(), F.lit(f"bad {f.name}"))
    return text.select(*[typed[c].alias(c) for c in ENRICHED_COLUMNS], reason.alias("reject_reason"),
                       *[F.col(c).alias(f"raw_{c}") for c in ENRICHED_COLUMNS])


def _scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENRICHED_TEXT).options(**READ_OPTIONS).csv(path)


def read_enriched_csv(spark: SparkSession, path: str) -> DataFrame:
    """Scan the enriched file back as typed staging rows; invalid rows are skipped."""
    return type_enriched(_scan(spark, path)).where(F.col("reject_reason").isNull()).select(*ENRICHED_COLUMNS)


def rejected_enriched_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows :func:`read_enriched_csv` skips: their text and the first reason found."""
    return (type_enriched(_scan(spark, path)).where(F.col("reject_reason").isNotNull())
            .select(*[F.col(f"raw_{c}").alias(c) for c in ENRICHED_COLUMNS], "reject_reason"))
