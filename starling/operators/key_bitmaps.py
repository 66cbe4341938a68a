"""Foreign keys checked by bitmaps (K8).

An exact anti-join with a dimension too large to broadcast sends the fact's keys
through a shuffle.  Keys here are integers, and mostly dense: a map task of the fact packs the keys it
sees into bitmaps, one of 4 KB per 32,768 numbers, and only those are shuffled.
Per range of numbers, the union of the fact's and the dimension's bitmaps has
more bits than the dimension's exactly when the fact holds a key that the
dimension lacks.  Where no range has one, the key is done; only fact rows of the
ranges left meet the dimension in an exact anti-join, which counts them.

The answer is that of :func:`starling.operators.quality.check_foreign_keys` for
any integer keys.  It moves less where a map task meets a fair share of the keys of
a range (a few hundred of 32,768), as with the dense keys of
:mod:`starling.operators.surrogate`; for scattered keys, and
for a dimension that is broadcast, the plain check moves less.

Defined cases: a NULL key is no orphan; negative keys and zero are keys; an
empty dimension makes every key an orphan; an empty fact has none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from starling.operators.sizing import ROW_OVERHEAD, bounded_broadcast
from starling.schema import FOREIGN_KEYS, PRIMARY_KEYS
from starling.session import scratch_dir

RANGE_BYTES = ROW_OVERHEAD + 8
_RANGE, _BITS, _DIM = "__range", "__bits", "__of_dimension"


def key_bitmaps(rows: DataFrame, key: str) -> DataFrame:
    """``(__range, __bits)``: per range of 32,768 numbers, the keys that occur (partial on the map side)."""
    at = F.col(key).cast("long")
    return rows.where(F.col(key).isNotNull()).groupBy(F.bitmap_bucket_number(at).alias(_RANGE)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias(_BITS))


def ranges_with_orphans(fact: DataFrame, key: str, dimension: DataFrame, dim_key: str) -> DataFrame:
    """``(__range)``: the ranges in which the fact has a key that the dimension lacks."""
    both = key_bitmaps(fact, key).withColumn(_DIM, F.lit(False)).unionByName(
        key_bitmaps(dimension, dim_key).withColumn(_DIM, F.lit(True)))
    known = F.when(F.col(_DIM), F.col(_BITS))
    return both.groupBy(_RANGE).agg(
        F.bitmap_count(F.bitmap_or_agg(_BITS)).alias("n"),
        F.coalesce(F.max(F.bitmap_count(known)), F.lit(0)).alias("known")).where("n > known").select(_RANGE)


def orphan_rows(fact: DataFrame, key: str, dimension: DataFrame, dim_key: str, doubtful: DataFrame) -> DataFrame:
    """One row ``orphan_rows``: fact rows of the ``doubtful`` ranges whose key is not in the dimension."""
    rows = fact.where(F.col(key).isNotNull()).select(
        F.col(key), F.bitmap_bucket_number(F.col(key).cast("long")).alias(_RANGE)).join(doubtful, _RANGE, "left_semi")
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.join(dimension.select(F.col(dim_key).alias(key)), key, "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("orphan_rows"))


def check_foreign_keys(fact: DataFrame, dims: dict[str, DataFrame], foreign_keys: dict[str, str] = FOREIGN_KEYS,
                       primary_keys: dict[str, str] = PRIMARY_KEYS) -> DataFrame:
    """``key_column, dimension, orphan_rows``, as the exact check reports it.

    The doubtful ranges of all keys are written in one job.  A key without one is
    reported without another look at the fact; the ranges of the others are
    broadcast when their measured size fits, so that the fact is not shuffled by range.
    """
    spark = fact.sparkSession
    found = reduce(DataFrame.unionByName, [
        ranges_with_orphans(fact, col, dims[dim], primary_keys[dim]).withColumn("key_column", F.lit(col))
        for col, dim in foreign_keys.items()])
    path = scratch_dir(spark, "ranges-with-orphans")
    found.write.parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    counts = {r["key_column"]: r["count"] for r in found.groupBy("key_column").count().collect()}  # a row a key
    frames = []
    for col, dim in foreign_keys.items():
        n = counts.get(col, 0)
        if n:
            ranges = bounded_broadcast(found.where(F.col("key_column") == col).select(_RANGE), (n, n * RANGE_BYTES))
            orphans = orphan_rows(fact, col, dims[dim], primary_keys[dim], ranges)
        else:
            orphans = spark.range(1).select(F.lit(0).cast("long").alias("orphan_rows"))
        frames.append(orphans.select(F.lit(col).alias("key_column"), F.lit(dim).alias("dimension"), "orphan_rows"))
    return reduce(DataFrame.unionByName, frames)
