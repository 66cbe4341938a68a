"""A log of micro-batches with atomic commits, and its compaction (T4, T5).

Layout below the log's folder::

    batch_id=N/attempt=<id>/...     the files of one attempt to write batch N (<id>.<buckets> when bucketed)
    _commits/<N>-<id>               empty; its creation commits that attempt
    _snapshots/<N>-<id>/...         one row per key over the batches up to N
    _snapshot_commits/<N>-<buckets>-<id>

Readers list the commits and read only what they name.  An attempt that died
between its files is never read, a batch replayed after its commit is not
written again, and should two writers commit one batch, every reader takes the
attempt whose name comes first.  Creating an empty file is atomic on every file
system, so nothing is renamed or overwritten.

With ``bucket_by``, batches too are written bucketed and sorted by that key: a
batch is reduced by the key, and meets the snapshot or another batch, without
a shuffle of its wide rows; several batches read together are shuffled.

Compaction (:meth:`BatchLog.compact`) writes one row per key, bucketed and sorted
by the key.  Readers merge it with the batches behind it: the tail is reduced and
shuffled into the buckets, the snapshot is read in place (:meth:`BatchLog.latest`).
The next compaction reads the last snapshot the same way.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from starling.operators.keep import keep_last
from starling.operators.warehouse import catalog_usable, save_bucketed

_DIGITS = 20


class BatchLog:
    """The log at ``root`` of rows of ``schema``; its batches are bucketed by ``bucket_by``, when given."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType | None = None, bucket_by: str | None = None):
        self.spark, self.root, self.schema, self.bucket_by = spark, root.rstrip("/"), schema, bucket_by
        self._tables: dict[str, str] = {}  # by folder

    # ------------------------------------------------------------------ files
    def _path(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _names(self, folder: str) -> list[str]:
        fs, path = self._path(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def _create(self, name: str) -> None:
        fs, path = self._path(name)
        if not fs.createNewFile(path):
            raise RuntimeError(f"{path.toString()} exists")

    def _delete(self, name: str) -> None:
        fs, path = self._path(name)
        if fs.exists(path):
            fs.delete(path, True)

    # ------------------------------------------------------------------ batches
    def committed(self) -> dict[int, str]:
        """The attempt to read of every committed batch."""
        out: dict[int, str] = {}
        for name in self._names("_commits"):
            batch, attempt = name.split("-", 1)
            out.setdefault(int(batch), attempt)
        return out

    def write(self, rows: DataFrame, batch_id: int, dealt: bool = False) -> str:
        """The files of a new attempt; nobody reads them before :meth:`commit`.

        ``dealt``: the rows come dealt out by the bucket key already, and are not shuffled for the buckets.
        """
        attempt = uuid.uuid4().hex
        if self.bucket_by and catalog_usable(self.spark):
            buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            bucketed, table = f"{attempt}.{buckets}", f"starling_batch_{attempt[:12]}"
            rows = rows if dealt else rows.repartition(buckets, self.bucket_by)
            save_bucketed(self.spark, rows, self._attempt(batch_id, bucketed), self.bucket_by, table, buckets)
            self.spark.sql(f"DROP TABLE {table}")  # external: the files stay
            return bucketed
        rows.write.parquet(self._attempt(batch_id, attempt))
        return attempt

    def _attempt(self, batch_id: int, attempt: str) -> str:
        return f"{self.root}/batch_id={batch_id}/attempt={attempt}"

    def commit(self, batch_id: int, attempt: str) -> None:
        self._create(f"_commits/{batch_id:0{_DIGITS}d}-{attempt}")

    def append(self, rows: DataFrame, batch_id: int, dealt: bool = False) -> bool:
        """Write and commit a batch (see :meth:`write`); False when it is committed already."""
        through = self.compacted()
        if batch_id in self.committed() or (through is not None and batch_id <= through[0]):
            return False
        self.commit(batch_id, self.write(rows, batch_id, dealt))
        return True

    def read(self, after: int = -1, through: int | None = None) -> DataFrame:
        """The rows of the committed batches behind ``after``, up to ``through``, with their ``batch_id``."""
        found = [(b, a) for b, a in sorted(self.committed().items()) if b > after and (through is None or b <= through)]
        schema = T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())])
        if not found:
            return self.spark.createDataFrame([], schema)
        if len(found) == 1 and "." in found[0][1] and self.bucket_by and catalog_usable(self.spark):
            (b, a), = found
            return self._bucketed(self._attempt(b, a), self.bucket_by, int(a.split(".")[1])).withColumn(
                "batch_id", F.lit(b).cast("long"))
        # several batches are read by their files: a union of buckets is not one table in buckets
        at = T.StructType([*schema.fields, T.StructField("attempt", T.StringType())])
        return self.spark.read.schema(at).option("basePath", self.root).parquet(
            *[self._attempt(b, a) for b, a in found]).drop("attempt")

    def _bucketed(self, path: str, key: str, buckets: int) -> DataFrame:
        """The rows of a folder written in buckets, read as buckets."""
        if path not in self._tables:
            table = f"starling_log_{uuid.uuid4().hex[:12]}"
            columns = self.spark.createDataFrame([], self.schema)._jdf.schema().toDDL()
            self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
                           f"INTO {buckets} BUCKETS LOCATION '{path}'")
            self._tables[path] = table
        return self.spark.table(self._tables[path])

    # ------------------------------------------------------------------ snapshots
    def compacted(self) -> tuple[int, str, int] | None:
        """(last batch covered, folder, buckets) of the newest snapshot."""
        found = [(int(n.split("-")[0]), n) for n in self._names("_snapshot_commits")]
        if not found:
            return None
        through = max(b for b, _ in found)
        _, buckets, attempt = min(n for b, n in found if b == through).split("-")
        return through, f"{self.root}/_snapshots/{through:0{_DIGITS}d}-{attempt}", int(buckets)

    def _snapshot(self, key: str) -> tuple[int, DataFrame | None]:
        newest = self.compacted()
        if newest is None:
            return -1, None
        through, path, buckets = newest
        if not buckets:
            return through, self.spark.read.schema(self.schema).parquet(path)
        return through, self._bucketed(path, key, buckets)

    def latest(self, key: str, order: Sequence[str], through: int | None = None, of: DataFrame | None = None) -> DataFrame:
        """One row per key: the greatest in ``order``, then in the other columns, over snapshot and tail.

        The snapshot is not shuffled: it is read in its buckets, and the tail, one row per key
        by then, comes to it.  ``of`` holds the keys that are asked for (default: all); the rows
        of others leave before they are reduced.
        """
        covered, snapshot = self._snapshot(key)
        rows = self.read(covered, through).select(*self.schema.fieldNames())
        if of is not None:
            rows = rows.join(of.select(key), key, "left_semi").select(*self.schema.fieldNames())
            snapshot = None if snapshot is None else snapshot.join(of.select(key), key, "left_semi")
        tail = keep_last(rows, key, order)
        if snapshot is None:
            return tail
        rest = [c for c in self.schema.fieldNames() if c != key and c not in order]

        def packed(df: DataFrame, name: str) -> DataFrame:
            return df.select(key, F.struct(*order, *rest).alias(name))

        both = packed(snapshot, "old").join(packed(tail, "new").withColumn("changed", F.lit(True)), key, "full_outer")
        newer = F.col("changed").isNotNull() & (F.col("old").isNull() | (F.col("new") > F.col("old")))
        picked = both.select(key, F.when(newer, F.col("new")).otherwise(F.col("old")).alias("row"))
        return picked.select(*[F.col(c) if c == key else F.col(f"row.{c}").alias(c) for c in self.schema.fieldNames()])

    def compact(self, key: str, order: Sequence[str], through: int | None = None) -> int | None:
        """Write one row per key over the batches up to ``through`` (default: all) as a new snapshot; returns the
        last batch it covers.  Until its commit, and if it dies before, readers use what was there."""
        ids = [b for b in self.committed() if through is None or b <= through]
        newest = self.compacted()
        if not ids or (newest is not None and max(ids) <= newest[0]):
            return None if newest is None else newest[0]
        last, attempt = max(ids), uuid.uuid4().hex
        path = f"{self.root}/_snapshots/{last:0{_DIGITS}d}-{attempt}"
        rows = self.latest(key, order, last)
        table = f"starling_compacted_{attempt[:12]}"
        buckets = newest[2] if newest else int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        if buckets and save_bucketed(self.spark, rows, path, key, table, buckets):
            self.spark.sql(f"DROP TABLE {table}")  # external: the files stay
        else:
            buckets = 0
            rows.write.parquet(path)
        self._create(f"_snapshot_commits/{last:0{_DIGITS}d}-{buckets}-{attempt}")
        return last

    def vacuum(self) -> list[int]:
        """Delete what no reader of the present state needs: batches that the newest snapshot covers, older
        snapshots, and files without a commit.  Only for a log that nobody else writes or reads just now."""
        newest, live = self.compacted(), self.committed()
        covered = [b for b in live if newest is not None and b <= newest[0]]
        for name in self._names("_commits"):
            if int(name.split("-")[0]) in covered:
                self._delete(f"_commits/{name}")
        for folder in [n for n in self._names("") if n.startswith("batch_id=")]:
            for attempt in self._names(folder):
                b = int(folder.split("=")[1])
                if b in covered or attempt != f"attempt={live.get(b)}":
                    self._delete(f"{folder}/{attempt}")
            if not self._names(folder):
                self._delete(folder)
        if newest is not None:
            keep = newest[1].rsplit("/", 1)[1]
            for name in self._names("_snapshot_commits"):
                if not keep.endswith(name.split("-")[2]):
                    self._delete(f"_snapshot_commits/{name}")
            for name in self._names("_snapshots"):
                if name != keep:
                    self._delete(f"_snapshots/{name}")
        return sorted(covered)

    def close(self) -> None:
        """Take the snapshots that this object read out of the catalog; their files stay."""
        for table in self._tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._tables.clear()
