"""Dense surrogate keys that stay the same across loads (K1).

An auto-increment numbers rows one by one.  Here the new values of a load are
range-partitioned and numbered inside their partitions; a table with one row per
partition turns the partitions' counts into offsets by a running sum.  A number
is the value's rank among the new ones plus the numbers given before, so it does
not depend on where the partitions were cut, and the numbers have no gap.

The map from value to number is kept as pieces in a log of atomic commits, one
piece per load: a value keeps its number for ever, a load that died gives no
number, and a load that is repeated gives none twice.  One writer at a time.

At scale: a load shuffles its distinct values twice (the distinct, the ranges) and
joins them to the map; rows per value are collapsed before the first shuffle, so
a hot value is one row per map task.  The window runs over one row per partition.

Defined cases: NULL gets no number; a load without new values adds an empty
piece; an empty map gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from starling.session import scratch_dir
from starling.streaming.batch_log import BatchLog

_PID, _OFFSET = "__pid", "__offset"


def dense_numbers(values: DataFrame, value: str, number: str, start: int = 1) -> DataFrame:
    """``(value, number)``: the distinct non-NULL values in their order, numbered from ``start`` without a gap."""
    spark = values.sparkSession
    ordered = (values.select(value).where(F.col(value).isNotNull()).distinct()
               .repartitionByRange(F.col(value)).withColumn(_PID, F.spark_partition_id()))
    # written once: the partition of a value is then a fact, also for a task that runs again
    path = scratch_dir(spark, "dense-numbers")
    ordered.write.parquet(path)
    ordered = spark.read.schema(ordered.schema).parquet(path)
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)  # over one row per partition
    offsets = ordered.groupBy(_PID).agg(F.count(F.lit(1)).alias("n")).select(
        _PID, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(_OFFSET))
    inside = Window.partitionBy(_PID).orderBy(value)
    return ordered.withColumn("n", F.row_number().over(inside)).join(offsets, _PID).select(
        value, (F.col(_OFFSET) + F.col("n") + F.lit(start - 1)).cast("long").alias(number))


class KeyMap:
    """The numbers given to the values of one column, at ``root``."""

    def __init__(self, spark: SparkSession, root: str, value: str, value_type: T.DataType, number: str):
        self.spark, self.value, self.number = spark, value, number
        self.log = BatchLog(spark, root, T.StructType([
            T.StructField(value, value_type), T.StructField(number, T.LongType())]))

    def table(self) -> DataFrame:
        """``(value, number)`` of every value of the committed loads."""
        return self.log.read().select(self.value, self.number)

    def load(self, values: DataFrame, load_id: int) -> bool:
        """Number the values that the map does not hold; False when the load was committed before."""
        committed = self.log.committed()
        if load_id in committed:
            return False
        if committed and load_id < max(committed):
            raise ValueError(f"load {load_id} comes after load {max(committed)}")
        known = self.table()
        new = values.select(self.value).distinct().join(known, self.value, "left_anti")
        return self.log.append(dense_numbers(new, self.value, self.number, known.count() + 1), load_id)

    def numbered(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the number of their value (NULL where the map has none)."""
        return rows.join(self.table(), self.value, "left")
