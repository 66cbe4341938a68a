"""CSV transaction feed: write, scan and type it.

The feed is positional: the reader applies an explicit schema by position.  A
line that starts with ``Order ID`` is a header line wherever it stands, and is
neither a transaction nor a rejected row; a file without one loses nothing.
Blank lines are skipped by the reader.

Every row carries its ``arrival``: (file modification time, file path, block
start, row).  It is taken at the scan, before any join, so the order of lines
does not depend on how later joins are carried out.  A stream numbers the rows
of a micro-batch in the same way, as it types them (:func:`type_scan`).  Lines
with a line number are ordered by it instead, whatever file they came in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from starling.functions import cleaning
from starling.schema import (ARRIVAL, FEED_BASE_COLUMNS, FEED_COLUMNS, FEED_HEADER, FEED_HEADER_PREFIX,
                             FEED_TEXT)

# CSV dialect of the feed: comma, double quote, doubled quote as escape, fields trimmed.
CSV_OPTIONS = {
    "header": "false",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "mode": "PERMISSIVE",
    "enforceSchema": "true",
}
WRITE_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
HEADER_LINE = "header line"
_FILE = "__file"  # (modification time, path, block start) of the row
_ROW = "__row"    # its place in the block


def write_feed_csv(feed_text: DataFrame, path: str, files: int | None = None) -> str:
    """Write feed text as CSV files, each with a header line: one per partition
    of the input, or ``files`` of them."""
    rows = feed_text.select(*FEED_COLUMNS).toDF(*FEED_HEADER)
    if files is not None:
        rows = rows.repartition(files)
    rows.write.mode("overwrite").options(**WRITE_OPTIONS).csv(path)
    return path


def _with_file(text: DataFrame) -> DataFrame:
    return text.select("*", F.struct("_metadata.file_modification_time", "_metadata.file_path",
                                     "_metadata.file_block_start").alias(_FILE))


def _arrival(row):
    return F.struct(
        F.col(f"{_FILE}.file_modification_time").alias("modified"), F.col(f"{_FILE}.file_path").alias("path"),
        F.col(f"{_FILE}.file_block_start").alias("block"), row.alias("row"))


def number_arrivals(text: DataFrame) -> DataFrame:
    """Replace the file columns of a scan by ``arrival``, adding the row's place in its block."""
    return text.withColumn(ARRIVAL, _arrival(F.monotonically_increasing_id())).drop(_FILE)


def read_feed_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Scan a CSV feed folder, or files, as text columns, bound by position, with ``arrival``."""
    return number_arrivals(_with_file(spark.read.schema(FEED_TEXT).options(**CSV_OPTIONS).csv(path)))


def empty_feed_text(spark: SparkSession) -> DataFrame:
    """The result of :func:`read_feed_text` for a feed without files."""
    place = T.StructType([T.StructField("file_modification_time", T.TimestampType()),
                          T.StructField("file_path", T.StringType()), T.StructField("file_block_start", T.LongType())])
    return number_arrivals(spark.createDataFrame([], T.StructType([*FEED_TEXT.fields, T.StructField(_FILE, place)])))


def stream_feed_text(spark: SparkSession, path: str, files_per_trigger: int | None = None,
                     bytes_per_trigger: int | None = None) -> DataFrame:
    """The same scan as a stream, bounded per micro-batch by files or by bytes; the
    rows are numbered inside ``foreachBatch`` (:func:`type_scan`)."""
    reader = spark.readStream.schema(FEED_TEXT).options(**CSV_OPTIONS)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return _with_file(reader.csv(path))


def _typed() -> dict:
    return {
        "order_id": cleaning.strict_long("order_id"),
        "order_date": cleaning.strict_timestamp("order_date"),
        "product_id": cleaning.strict_long("product_id"),
        "quantity": cleaning.strict_int("quantity"),
        "customer_id": cleaning.strict_long("customer_id"),
        "supplier_id": cleaning.strict_long("supplier_id"),
        "line_number": cleaning.strict_int("line_number"),
    }


def _reject_reason(typed: dict, raw: dict):
    """The first reason to reject a row (NULL for a good one), of its typed and raw columns."""
    reason = F.when(F.trim(raw["order_id"]).startswith(FEED_HEADER_PREFIX), F.lit(HEADER_LINE))
    for c in FEED_COLUMNS:
        bad = typed[c].isNull() if c in FEED_BASE_COLUMNS else (
            raw[c].isNotNull() & (F.trim(raw[c]) != "") & typed[c].isNull())
        reason = reason.when(bad, F.lit(f"bad {c}"))
    return reason.alias("reject_reason")


def _when_unnumbered(line_number, arrival):
    return F.when(line_number.isNull(), arrival).alias(ARRIVAL)


def type_feed(text: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Typed columns plus ``reject_reason`` (NULL for a good row) and the raw text.

    The five base columns are required; ``supplier_id`` and ``line_number``
    may be absent (a five-column feed) but must be numbers when present.
    ``carry`` names further columns of ``text`` to pass through; an arrival is
    kept only for lines without a line number, the ones it orders.
    """
    typed = _typed()
    return text.select(
        *[typed[c].alias(c) for c in FEED_COLUMNS],
        _reject_reason(typed, {c: F.col(c) for c in FEED_COLUMNS}),
        *[F.col(c).alias(f"raw_{c}") for c in FEED_COLUMNS],
        *[_when_unnumbered(typed["line_number"], F.col(c)) if c == ARRIVAL else F.col(c) for c in carry],
    )


def type_scan(text: DataFrame) -> DataFrame:
    """:func:`type_feed` of a scan, with ``arrival``: numbered and typed in one step.

    The row number holds a filter on the reason above that step, so every column is typed
    once; a filter pushed below the typing types all of them a second time.
    """
    typed = _typed()
    rows = text.select(*[typed[c].alias(c) for c in FEED_COLUMNS], *[F.col(c).alias(f"raw_{c}") for c in FEED_COLUMNS],
                       _FILE, F.monotonically_increasing_id().alias(_ROW))
    return rows.select(
        *FEED_COLUMNS,
        _reject_reason({c: F.col(c) for c in FEED_COLUMNS}, {c: F.col(f"raw_{c}") for c in FEED_COLUMNS}),
        *[f"raw_{c}" for c in FEED_COLUMNS],
        _when_unnumbered(F.col("line_number"), _arrival(F.col(_ROW))))


def _carried(text: DataFrame) -> tuple[str, ...]:
    return tuple(c for c in (ARRIVAL,) if c in text.columns)


def clean_feed(text: DataFrame) -> DataFrame:
    """Good rows only, typed, with ``arrival`` when the text has it."""
    carry = _carried(text)
    return type_feed(text, carry).where(F.col("reject_reason").isNull()).select(*FEED_COLUMNS, *carry)


def quarantine(text: DataFrame) -> DataFrame:
    """Rejected rows: the raw text and the first reason found (header lines are none)."""
    return (type_feed(text).where(F.col("reject_reason") != HEADER_LINE)
            .select(*[F.col(f"raw_{c}").alias(c) for c in FEED_COLUMNS], "reject_reason"))


def header_lines(text: DataFrame) -> DataFrame:
    """The header lines among the rows of a scan."""
    return text.where(F.trim(F.col("order_id")).startswith(FEED_HEADER_PREFIX))
