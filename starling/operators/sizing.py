"""Broadcast hints behind a measured size.

A written table records its rows and bytes when it is saved; a hint is given
only when they fit the session's ``spark.sql.autoBroadcastJoinThreshold``
(10 MB by default; -1 turns hints off too).  Spark's own estimate assumes about
20 bytes a string; here strings count at their length.  Joins of anything that
was not written are left to Spark, which measures shuffled sides at run time.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

DEFAULT_MAX_BYTES = 10 * 1024 * 1024
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}
ROW_OVERHEAD = 16   # bytes per row besides its fields

_FIXED_BYTES = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4,
    T.FloatType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8,
}


def parse_bytes(text: str) -> int:
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]*)\s*", str(text))
    if not m or m.group(2).lower() not in _UNITS:
        return DEFAULT_MAX_BYTES
    return int(m.group(1)) * _UNITS[m.group(2).lower()]


def broadcast_budget(spark: SparkSession) -> int:
    """Bytes a side may take to be broadcast; 0 when the session turns broadcasts off."""
    n = parse_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", str(DEFAULT_MAX_BYTES)))
    return max(0, n)


def _fixed(t: T.DataType) -> int | None:
    if isinstance(t, T.DecimalType):
        return 8 if t.precision <= 18 else 16
    return _FIXED_BYTES.get(type(t))


def min_row_bytes(schema: T.StructType) -> int:
    """Least possible width of one row: fixed fields only (strings may be empty)."""
    return ROW_OVERHEAD + sum(_fixed(f.dataType) or 0 for f in schema.fields)


def row_width(schema: T.StructType):
    """Column with the width of each row: fixed fields plus the bytes of every
    variable-width value (strings and binaries by length)."""
    width = F.lit(min_row_bytes(schema))
    for f in schema.fields:
        if _fixed(f.dataType) is None:
            width = width + F.coalesce(F.octet_length(F.col(f.name).cast("string")), F.lit(0))
    return width


def table_size(df: DataFrame) -> tuple[int, int]:
    """Exact ``(rows, bytes)`` of a table in one distributed aggregate."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_width(df.schema)).alias("b")).first()
    return int(r.n), int(r.b or 0)


def bounded_broadcast(df: DataFrame, size: tuple[int, int] | None, max_bytes: int | None = None) -> DataFrame:
    """``broadcast(df)`` if its measured ``size`` (rows, bytes) fits ``max_bytes``
    (default: the session's broadcast budget), else ``df``."""
    budget = broadcast_budget(df.sparkSession) if max_bytes is None else max_bytes
    return F.broadcast(df) if size is not None and budget > 0 and size[1] <= budget else df
