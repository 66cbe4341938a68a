"""Key and null checks of the warehouse (K7, K8, K9, A4).

Each check is one lazy DataFrame, a small report with one row per table,
key or column, so all tables are checked in one job.  ``assert_clean``
collects such a report (a handful of rows) and fails the job on a violation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from starling.schema import FOREIGN_KEYS, PRIMARY_KEYS


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def check_primary_keys(tables: dict[str, DataFrame], keys: dict[str, str] = PRIMARY_KEYS) -> DataFrame:
    """``table_name, key_column, duplicate_keys``: keys held by more than one row."""
    frames = []
    for name, key in keys.items():
        dup = (tables[name].groupBy(key).count().where(F.col("count") > 1)
               .agg(F.count(F.lit(1)).alias("duplicate_keys")))
        frames.append(dup.select(F.lit(name).alias("table_name"), F.lit(key).alias("key_column"),
                                 F.col("duplicate_keys").cast("long").alias("duplicate_keys")))
    return _union(frames)


def check_foreign_keys(fact: DataFrame, dims: dict[str, DataFrame],
                       foreign_keys: dict[str, str] = FOREIGN_KEYS,
                       primary_keys: dict[str, str] = PRIMARY_KEYS) -> DataFrame:
    """``key_column, dimension, orphan_rows``: fact rows whose non-NULL key is not in the dimension.

    Rows are counted per key first (map-side partial), so a hot key meets the
    dimension as one row.
    """
    frames = []
    for col, dim in foreign_keys.items():
        pk = primary_keys[dim]
        orphans = (fact.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
                   .join(dims[dim].select(F.col(pk).alias(col)), col, "left_anti")
                   .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows")))
        frames.append(orphans.select(F.lit(col).alias("key_column"), F.lit(dim).alias("dimension"),
                                     F.col("orphan_rows").cast("long").alias("orphan_rows")))
    return _union(frames)


def check_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column_name, null_rows`` in one pass over ``df``."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).cast("long").alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "null_rows")


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    """A4: ``count(*)`` as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).cast("long").alias(name))


def assert_clean(report: DataFrame, count_column: str) -> None:
    bad = report.where(F.col(count_column) > 0).collect()
    if bad:
        raise ValueError(f"warehouse check failed: {[r.asDict() for r in bad]}")
