"""Structured Streaming enrichment of the transaction feed.

* T1 micro-batches: the CSV feed folder is read as a stream, bounded per batch
  by a number of files or of bytes.
* T2 bounded feed: ``trigger(availableNow=True)`` drains what is there,
  including the last partial batch, then stops; an empty feed gives an empty log.
* T3 stream-static joins: every micro-batch is numbered at its scan, typed, and
  then joined to the static masters inside ``foreachBatch``.  The arrival is
  taken before any join, so it is the same whichever join Spark picks.
* T4 sink: each micro-batch is an attempt in a log of atomic commits
  (``batch_log.py``): files of an attempt that died are never read, and a batch
  replayed after its commit is not written again.  The checkpoint folder makes
  the query resume where it stopped.
* T5 keep-last per order: by default computed when the log is read, over the
  newest snapshot and the batches behind it once the log is compacted
  (:func:`compact_log`, :func:`latest_compacted`); the keyed-state form keeps ids and ordering columns per order in the
  RocksDB state store (:func:`stream_latest_state_to_log`).  "Last" is the line
  number where there is one, then the arrival, as in batch.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from starling.operators import enrich as E
from starling.operators.keep import keep_last
from starling.operators.warehouse import save_bucketed
from starling.schema import ARRIVAL, ENRICHED, ENRICHED_COLUMNS, FEED, FEED_COLUMNS, FEED_TEXT
from starling.session import scratch_dir
from starling.sources import feed_csv
from starling.streaming.batch_log import BatchLog
from starling.streaming.state_session import rocksdb_session

MASTER_KEYS = {"customers": "customer_id", "products": "product_id", "suppliers": "supplier_id"}
ARRIVAL_TYPE = T.StructType([T.StructField("modified", T.TimestampType()), T.StructField("path", T.StringType()),
                             T.StructField("block", T.LongType()), T.StructField("row", T.LongType())])
_ORDER_FIELDS = [T.StructField("line_number", T.IntegerType()), T.StructField(ARRIVAL, ARRIVAL_TYPE)]
LOG_SCHEMA = T.StructType([*ENRICHED.fields, *_ORDER_FIELDS])
QUARANTINE_SCHEMA = T.StructType([*FEED_TEXT.fields, T.StructField("reject_reason", T.StringType())])
# What the keyed state holds per order: no names, they come from the masters when the state is read.
STATE_SCHEMA = T.StructType([f for f in FEED.fields if f.name != "line_number"] + _ORDER_FIELDS)


class Masters(list):
    """The written masters (customers, products, suppliers, stores) and their catalog names."""

    def __init__(self, frames: list, tables: list[str]):
        super().__init__(frames)
        self.tables = tables


def load_masters(spark: SparkSession, root: str, customers: DataFrame, products: DataFrame,
                 suppliers: DataFrame | None = None, stores: DataFrame | None = None,
                 bucketed: bool = True) -> "Masters":
    """Reduce the masters to one row per key and write them once, before the
    feed starts; every micro-batch then joins these tables as they are.

    With ``bucketed``, customers, products and suppliers are written bucketed
    and sorted by their key (external tables at ``root``, under unique names in
    the session catalog, see :func:`drop_masters`).  A master too large to
    broadcast is then read pre-partitioned by every micro-batch: only the
    batch's own rows are shuffled to meet it, never the master.
    """
    run = uuid.uuid4().hex[:12]
    tables: list[str] = []

    def save(name, df):
        if df is None:
            return None
        path = f"{root}/{name}"
        if bucketed and name in MASTER_KEYS:
            table = f"starling_{name}_{run}"
            if save_bucketed(spark, df, path, MASTER_KEYS[name], table):
                tables.append(table)
                return spark.table(table)
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    names = ["customers", "products", "suppliers", "stores"]
    with ThreadPoolExecutor(max_workers=len(names)) as pool:  # independent jobs, run together
        futures = [pool.submit(save, n, df)
                   for n, df in zip(names, E.unique_masters(customers, products, suppliers, stores))]
        return Masters([f.result() for f in futures], tables)


def drop_masters(spark: SparkSession, masters: "Masters") -> None:
    """Take bucketed masters out of the catalog; their files stay."""
    for table in masters.tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def typed_batch(batch: DataFrame) -> DataFrame:
    """A micro-batch of feed text, numbered at its scan and typed."""
    return feed_csv.type_scan(batch)


def enrich_batch(batch: DataFrame, masters: list, keep_order_columns: bool = True) -> DataFrame:
    """The matched lines of a micro-batch of feed text."""
    good = typed_batch(batch).where(F.col("reject_reason").isNull()).select(*FEED_COLUMNS, ARRIVAL)
    return E.enrich(good, *masters, keep_order_columns=keep_order_columns, masters_unique=True)


def _bad_rows(batch: DataFrame) -> DataFrame:
    return typed_batch(batch).where(F.col("reject_reason") != feed_csv.HEADER_LINE).select(
        *[F.col(f"raw_{c}").alias(c) for c in FEED_COLUMNS], "reject_reason")


def _batch_writer(out_dir: str, transform=None):
    """Commit each micro-batch to the log at ``out_dir``, once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        out = batch if transform is None else transform(batch)
        BatchLog(batch.sparkSession, out_dir).append(out, batch_id)
    return write


def run_to_log(stream: DataFrame, out_dir: str, checkpoint_dir: str, transform=None, mode: str = "append") -> None:
    """Drain a bounded stream into the log at ``out_dir`` and wait for it."""
    q = (stream.writeStream.outputMode(mode).foreachBatch(_batch_writer(out_dir, transform))
         .option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def read_log(spark: SparkSession, out_dir: str, schema: T.StructType) -> DataFrame:
    """The committed batches of a log with their ``batch_id``."""
    return BatchLog(spark, out_dir, schema).read()


def stream_enrich_to_log(spark: SparkSession, feed_dir: str, customers: DataFrame, products: DataFrame,
                         suppliers: DataFrame | None = None, stores: DataFrame | None = None,
                         files_per_trigger: int | None = None, bytes_per_trigger: int | None = None,
                         root: str | None = None, quarantine: bool = False,
                         bucketed: bool = True) -> tuple[str, str | None]:
    """Run the enrichment stream over ``feed_dir``; return (log folder, quarantine folder).

    The quarantine is a second query over the same source with its own
    checkpoint, run only when asked for.
    """
    root = root or scratch_dir(spark, "stream")
    masters = load_masters(spark, f"{root}/masters", customers, products, suppliers, stores, bucketed)
    text = feed_csv.stream_feed_text(spark, feed_dir, files_per_trigger, bytes_per_trigger)
    run_to_log(text, f"{root}/enriched", f"{root}/_checkpoint_enriched", lambda b: enrich_batch(b, masters))
    drop_masters(spark, masters)
    if not quarantine:
        return f"{root}/enriched", None
    run_to_log(text, f"{root}/quarantine", f"{root}/_checkpoint_quarantine", _bad_rows)
    return f"{root}/enriched", f"{root}/quarantine"


def enriched_from_log(spark: SparkSession, log_dir: str) -> DataFrame:
    """The enriched lines of every batch (line grain, 14 columns)."""
    return read_log(spark, log_dir, LOG_SCHEMA).select(*ENRICHED_COLUMNS)


def latest_from_log(spark: SparkSession, log_dir: str) -> DataFrame:
    """T5: last matched line per order over the whole log."""
    return E.latest_per_order(read_log(spark, log_dir, LOG_SCHEMA).drop("batch_id"))


_LOG_ORDER = E.line_order(LOG_SCHEMA.fieldNames())


def compact_log(spark: SparkSession, log_dir: str, through: int | None = None) -> int | None:
    """Compact the enriched log up to batch ``through`` (default: all) into one row per order."""
    log = BatchLog(spark, log_dir, LOG_SCHEMA)
    try:
        return log.compact("order_id", _LOG_ORDER, through)
    finally:
        log.close()


def latest_compacted(spark: SparkSession, log_dir: str) -> DataFrame:
    """T5: last matched line per order, from the newest snapshot and the batches behind it.

    A bucketed snapshot stays in the session catalog, as the plan reads it there.
    """
    return BatchLog(spark, log_dir, LOG_SCHEMA).latest("order_id", _LOG_ORDER).select(*ENRICHED_COLUMNS)


def stream_latest_state_to_log(spark: SparkSession, feed_dir: str, customers: DataFrame,
                               products: DataFrame, suppliers: DataFrame | None = None,
                               stores: DataFrame | None = None, files_per_trigger: int | None = None,
                               bytes_per_trigger: int | None = None, root: str | None = None) -> str:
    """T5 as keyed streaming state: ``groupBy(order_id)`` keeps the last matched
    line per order in the state store (update mode); every micro-batch writes
    the orders it changed to its log.

    A first query numbers and matches the lines and logs them with key columns
    only; the stateful query streams over that log.  The state holds one narrow
    row per order and never expires, so it lives in RocksDB, on disk.
    :func:`latest_from_log` is the stateless alternative.
    """
    root = root or scratch_dir(spark, "stream-state")
    masters = load_masters(spark, f"{root}/masters", customers, products, suppliers, stores)
    keys = [None if m is None else m.select(*[c for c in m.columns if not c.endswith("_name")]) for m in masters]
    lookups = E.Lookups(*keys)

    def matched(batch: DataFrame) -> DataFrame:
        good = typed_batch(batch).where(F.col("reject_reason").isNull()).select(*FEED_COLUMNS, ARRIVAL)
        return E.matched_keys(good, lookups).select(*STATE_SCHEMA.fieldNames())

    text = feed_csv.stream_feed_text(spark, feed_dir, files_per_trigger, bytes_per_trigger)
    run_to_log(text, f"{root}/matched", f"{root}/_checkpoint_matched", matched)
    drop_masters(spark, masters)
    if not BatchLog(spark, f"{root}/matched").committed():  # an empty feed
        return f"{root}/state_log"
    # files of a dead attempt would hold rows of the committed one: they change no last line
    rows = rocksdb_session(spark).readStream.schema(STATE_SCHEMA).parquet(f"{root}/matched/batch_id=*/attempt=*")
    latest = keep_last(rows, "order_id", E.line_order(rows.columns, "quantity"))
    run_to_log(latest, f"{root}/state_log", f"{root}/_checkpoint_state", mode="update")
    return f"{root}/state_log"


def latest_from_state_log(spark: SparkSession, log_dir: str, customers: DataFrame, products: DataFrame,
                          suppliers: DataFrame | None = None, stores: DataFrame | None = None) -> DataFrame:
    """The current state, enriched: for every order, its row from the latest batch that changed it."""
    state = keep_last(read_log(spark, log_dir, STATE_SCHEMA), "order_id", ["batch_id"]).drop("batch_id", ARRIVAL)
    return E.enrich(state, customers, products, suppliers, stores)
