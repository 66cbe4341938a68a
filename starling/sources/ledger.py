"""Ledger of delivered feed files (S1, T1): a file delivered twice loads once.

A delivery is a folder of files.  Files that the ledger knows by path, size and
modification time are passed over without being opened.  The others get a
fingerprint of their content, computed in one pass that Spark splits as any scan
of text: their size, their number of lines, the sum and the exclusive or of two
hashes of every line.  Per batch, of files with equal fingerprints the one whose
path comes first is to be loaded, and none when an earlier batch had it.

The ledger is a :class:`BatchLog`: a batch's decision is committed once, and a
batch that is repeated gets the files it got before, so the load behind it, under
the same batch id, stays replay-safe.  Decisions are joins; only the paths of the
files to load reach the driver, as any scan lists its files there.

Defined cases: an empty file has no rows and is never loaded; files with the same
lines in another order have equal fingerprints (their rows are the same); an
empty folder gives a batch without files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from starling.operators.keep import keep_first
from starling.sources import feed_csv
from starling.streaming.batch_log import BatchLog

FINGERPRINT = ["size", "n_lines", "line_sum", "line_mix"]
LEDGER = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modified", T.TimestampType()),
    T.StructField("size", T.LongType()),
    T.StructField("n_lines", T.LongType()),
    T.StructField("line_sum", T.DecimalType(38, 0)),
    T.StructField("line_mix", T.LongType()),
    T.StructField("load", T.BooleanType()),
])


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """path, modified, size of the files in a folder; their content is not read."""
    return spark.read.format("binaryFile").load(folder).select(
        "path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def fingerprints(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, size, n_lines, line_sum, line_mix of every file with a line."""
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
        F.xxhash64("value").alias("a"), F.xxhash64(F.lit(1), "value").alias("b"))
    return lines.groupBy("path", "size").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("a").cast("decimal(20,0)")).cast("decimal(38,0)").alias("line_sum"),
        F.bit_xor("b").alias("line_mix"))


class FeedLedger:
    """The ledger at ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.log = spark, BatchLog(spark, root, LEDGER)

    def files(self) -> DataFrame:
        """Every file seen, with its fingerprint, whether it was to be loaded, and its batch."""
        return self.log.read()

    def claim(self, folder: str, batch_id: int) -> list[str]:
        """The files of a delivery that the batch is to load."""
        if batch_id not in self.log.committed():
            self.log.append(self._decide(folder), batch_id)
        return [r.path for r in self.files().where((F.col("batch_id") == batch_id) & F.col("load"))
                .select("path").orderBy("path").collect()]

    def _decide(self, folder: str) -> DataFrame:
        known = self.files().drop("batch_id")
        seen = [F.col("f.path") == F.col("k.path"), F.col("f.modified") == F.col("k.modified"), F.col("f.size") == F.col("k.size")]
        fresh = listing(self.spark, folder).alias("f").join(known.alias("k"), seen, "left_anti")
        paths = [r.path for r in fresh.select("path").collect()]
        if not paths:
            return self.spark.createDataFrame([], LEDGER)
        printed = fingerprints(self.spark, paths).withColumn("name", _name(_decoded("path")))
        read = fresh.withColumn("name", _name(F.col("path"))).drop("size").join(printed.drop("path"), "name").drop("name")
        first = keep_first(read.select(*FINGERPRINT, "path"), FINGERPRINT, ["path"]).join(
            known.where("load").select(*FINGERPRINT), FINGERPRINT, "left_anti")
        return read.join(first.select("path", F.lit(True).alias("first")), "path", "left").select(
            "path", "modified", *FINGERPRINT, F.coalesce("first", F.lit(False)).alias("load"))

    def read_feed(self, folder: str, batch_id: int) -> DataFrame:
        """The feed text of the files that the batch is to load, with their arrival."""
        paths = self.claim(folder, batch_id)
        if not paths:
            return feed_csv.empty_feed_text(self.spark)
        return feed_csv.read_feed_text(self.spark, paths)


def _decoded(path: str) -> Column:
    """A scan's ``file_path`` as a listing spells it, without percent codes (a plus stays one)."""
    return F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B")))


def _name(path: Column) -> Column:
    """A path without its scheme and the slashes at its front, which scans and listings spell in two ways."""
    return F.regexp_replace(path, "^([a-z0-9]+:)?/+", "")
