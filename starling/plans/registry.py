"""Named queries over the driver's test tables: one per operator of the survey.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables.  Source and sink operators write their files below the session's
checkpoint folder and return what reading them back gives.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from starling.functions import cleaning
from starling.operators import enrich as E
from starling.operators import clustering, key_bitmaps, olap, quality
from starling.operators import warehouse as W
from starling.plans import build as P
from starling.schema import CUSTOMER_MASTER, ENRICHED_COLUMNS, FEED_COLUMNS, FOREIGN_KEYS, PRIMARY_KEYS
from starling.session import scratch_dir
from starling.sources import dirt, enriched_csv, feed_csv, ledger, tables, testdata
from starling.streaming import feed_stream

Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------------ sources and cleaning
def _good(spark, feed_dir):
    return feed_csv.clean_feed(feed_csv.read_feed_text(spark, feed_dir))


def scan_transactions(spark, sf_dir):
    """The feed written as CSV files, scanned back by position and typed."""
    return _good(spark, P.feed_csv_dir(spark, sf_dir)).select(*FEED_COLUMNS)


def ingest_ledger(spark, sf_dir):
    """A feed delivered twice, under other file names the second time, loaded once."""
    book = ledger.FeedLedger(spark, scratch_dir(spark, "ledger"))
    once = book.read_feed(P.feed_in_parts_dir(spark, sf_dir), 0)
    again = book.read_feed(f"{P.delivered_again_dir(spark, sf_dir)}/*", 1)
    return feed_csv.clean_feed(once.unionByName(again)).select(*FEED_COLUMNS)


def scan_masters(spark, sf_dir):
    """The customer master with its three columns (pruned at the scan)."""
    source = ["c_custkey", "c_name", "c_mktsegment"]
    return tables.read_master(spark, f"{sf_dir}/customer.parquet", source).select(
        *[F.col(a).alias(f.name) for a, f in zip(source, CUSTOMER_MASTER.fields)])


def scan_product_master(spark, sf_dir):
    """The product master with its seven columns, supplier and store included."""
    return testdata.product_master_with_supplier(spark, sf_dir)


def clean_transactions(spark, sf_dir):
    """Typed good rows of a feed with bad quantities."""
    return _good(spark, P.feed_csv_dir(spark, sf_dir, dirty=True)).select(*FEED_COLUMNS)


def quarantine(spark, sf_dir):
    """P5: the rejected rows of the same feed, raw text and reason."""
    return feed_csv.quarantine(feed_csv.read_feed_text(spark, P.feed_csv_dir(spark, sf_dir, dirty=True)))


def clean_money(spark, sf_dir):
    """Money text (``$`` prefix, junk, empty) read tolerantly."""
    text = dirt.price_text(testdata.product_master(spark, sf_dir))
    return text.select("product_id", "price_text",
                       cleaning.money("price_text").alias("price"),
                       cleaning.money_is_defaulted("price_text").alias("defaulted"))


# ------------------------------------------------------------------ enrichment
def enrich_sales(spark, sf_dir):
    """Every matched line, 14 columns."""
    return P.enriched_lines(spark, sf_dir)


def master_first_match(spark, sf_dir):
    """A supplier master with second names, one row per id (least name wins)."""
    suppliers = dirt.suppliers_with_second_names(testdata.supplier_master(spark, sf_dir))
    return E.first_match(suppliers, "supplier_id", ["supplier_name", "store_id"])


def unmatched_transactions(spark, sf_dir):
    """Feed lines dropped by the enrichment when closed accounts are not in the customer master."""
    m = P.Masters(spark, sf_dir)
    return E.unmatched(testdata.feed(spark, sf_dir), dirt.open_customers(spark, sf_dir),
                       m.products, m.suppliers, m.stores)


def enrich_product_master(spark, sf_dir):
    """Every line of a five-column feed; supplier and store come with the product."""
    return E.enrich(_good(spark, P.five_column_feed_dir(spark, sf_dir)), lookups=P.product_lookups(spark, sf_dir))


def enrich_dirty_prices(spark, sf_dir):
    """Enrichment with prices read from money text, junk and empty text included."""
    products = testdata.product_master(spark, sf_dir)
    priced = dirt.price_text(products).select("product_id", cleaning.money("price_text").alias("product_price"))
    m = P.Masters(spark, sf_dir)
    lookups = E.prepare(m.customers, products.select("product_id", "product_name").join(priced, "product_id"),
                        m.suppliers, m.stores)
    return E.enrich_parts(testdata.feed_lines(spark, sf_dir), testdata.order_headers(spark, sf_dir), lookups)


def latest_per_order(spark, sf_dir):
    """The last matched line per order of a feed with line numbers."""
    return E.latest_lines(testdata.feed(spark, sf_dir), P.lookups(spark, sf_dir))


def latest_by_arrival(spark, sf_dir):
    """The last matched line to arrive per order, of a feed without line numbers."""
    return E.latest_lines(_good(spark, P.five_column_feed_dir(spark, sf_dir)), P.product_lookups(spark, sf_dir))


# ------------------------------------------------------------------ files and tables
def _enriched_csv_dir(spark, sf_dir):
    return P.cached(spark, sf_dir, "enriched-csv", lambda: enriched_csv.write_enriched_csv(
        P.warehouse(spark, sf_dir).table("staging"), scratch_dir(spark, "enriched-csv")))


def sink_enriched_csv(spark, sf_dir):
    """The staging table written as CSV; the data lines as written."""
    return enriched_csv.read_enriched_lines(spark, _enriched_csv_dir(spark, sf_dir))


def scan_enriched(spark, sf_dir):
    """The enriched CSV file scanned back into 14 typed columns."""
    return enriched_csv.read_enriched_csv(spark, _enriched_csv_dir(spark, sf_dir))


def load_staging(spark, sf_dir):
    """The scanned file bulk-loaded into a table, read back."""
    path = scratch_dir(spark, "output-data")
    tables.load_table(scan_enriched(spark, sf_dir), path)
    return tables.read_table(spark, path).select(*ENRICHED_COLUMNS)


def staging_preview(spark, sf_dir):
    """``select *`` of the staging table."""
    return P.warehouse(spark, sf_dir).table("staging").select("*")


# ------------------------------------------------------------------ warehouse
def _wh_table(name):
    def run(spark, sf_dir):
        return P.warehouse(spark, sf_dir).table(name)
    run.__name__ = name
    run.__doc__ = f"The warehouse table ``{name}``."
    return run


def build_fact(spark, sf_dir):
    """K6 with the dimension joins J7, J8."""
    wh = P.warehouse(spark, sf_dir)
    return W.build_fact(wh.table("staging"), wh.table("time_dim"), wh.table("product"),
                        wh.table("customer"), wh.table("store"), wh.table("supplier"))


def _loaded_table(name):
    def run(spark, sf_dir):
        return P.incremental_warehouse(spark, sf_dir).table(name)
    run.__name__ = f"load_{name}"
    run.__doc__ = f"S9: the warehouse table ``{name}`` after loads in batches that replace rows of earlier ones."
    return run


def load_view(spark, sf_dir):
    """K10 as a view with retractions, after the same loads."""
    return P.incremental_warehouse(spark, sf_dir).store_quarterly_sales()


def load_q1(spark, sf_dir):
    """Q1 over the incrementally loaded tables."""
    return olap.q1(P.incremental_warehouse(spark, sf_dir))


def _all_tables(wh):
    return {name: wh.table(name) for name in ["time_dim", "product", "customer", "store", "supplier", "sales"]}


def check_primary_keys(spark, sf_dir):
    """K7."""
    return quality.check_primary_keys(_all_tables(P.warehouse(spark, sf_dir)))


def check_foreign_keys(spark, sf_dir):
    """K8."""
    t = _all_tables(P.warehouse(spark, sf_dir))
    return quality.check_foreign_keys(t["sales"], t)


def check_foreign_keys_bitmap(spark, sf_dir):
    """K8 by bitmaps of the keys, over the loaded fact and over dimensions that lack every seventh key."""
    t = _all_tables(P.warehouse(spark, sf_dir))
    short = {name: t[name].where(F.col(PRIMARY_KEYS[name]) % 7 != 0) for name in set(FOREIGN_KEYS.values())}
    whole, holes = key_bitmaps.check_foreign_keys(t["sales"], t), key_bitmaps.check_foreign_keys(t["sales"], short)
    return whole.withColumn("keys", F.lit("all")).unionByName(holes.withColumn("keys", F.lit("without sevenths")))


def _dense_keys(column):
    def run(spark, sf_dir):
        return P.key_map(spark, sf_dir, column).table()
    run.__name__ = f"dense_{column}"
    run.__doc__ = f"K1: dense numbers of ``{column}``, given in three loads of which the last comes twice."
    return run


def fact_clustered(spark, sf_dir):
    """The fact written in Z-order of date, store and product, read back."""
    fact = P.warehouse(spark, sf_dir).table("sales")
    path = scratch_dir(spark, "sales-clustered")
    tables.write_table(clustering.cluster(fact, ["date_id", "store_id", "product_id"], "transaction_id"), path)
    return tables.read_table(spark, path, fact.schema)


def check_not_null(spark, sf_dir):
    """K9."""
    return quality.check_not_null(P.warehouse(spark, sf_dir).table("time_dim"),
                                  ["date", "day", "month", "year"])


def supplier_count(spark, sf_dir):
    """A4: ``count(*)`` of the supplier dimension."""
    return quality.row_count(P.warehouse(spark, sf_dir).table("supplier"))


# ------------------------------------------------------------------ OLAP
def _olap(fn, **kw):
    def run(spark, sf_dir):
        return fn(P.warehouse(spark, sf_dir), **kw)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def q6_lines(spark, sf_dir):
    """J10, J11, A3, O6 at line grain: the product pairs that orders hold together most often."""
    return olap.q6_lines(P.enriched_lines(spark, sf_dir), P.lookups(spark, sf_dir).products)


# ------------------------------------------------------------------ streaming
def _masters_args(spark, sf_dir):
    m = P.Masters(spark, sf_dir)
    return m.customers, m.products, m.suppliers, m.stores


# Size of a micro-batch of the registered streams: many files of any feed, so a
# batch keeps the cluster busy and the master scans are amortized.
BYTES_PER_TRIGGER = 64 << 30


def _stream_log(spark, sf_dir):
    return feed_stream.stream_enrich_to_log(spark, P.feed_csv_dir(spark, sf_dir), *_masters_args(spark, sf_dir),
                                            bytes_per_trigger=BYTES_PER_TRIGGER)[0]


def stream_enrich(spark, sf_dir):
    """The CSV feed streamed in micro-batches, enriched against the
    static masters; the batch log read back (line grain)."""
    return feed_stream.enriched_from_log(spark, _stream_log(spark, sf_dir))


def stream_latest_per_order(spark, sf_dir):
    """T5: keep-last per order over the streamed log."""
    return feed_stream.latest_from_log(spark, _stream_log(spark, sf_dir))


def stream_latest_by_arrival(spark, sf_dir):
    """T5: the last line to arrive per order, of a streamed feed without line numbers."""
    log, _ = feed_stream.stream_enrich_to_log(
        spark, P.five_column_feed_dir(spark, sf_dir), testdata.customer_master(spark, sf_dir),
        testdata.product_master_with_supplier(spark, sf_dir), bytes_per_trigger=BYTES_PER_TRIGGER)
    return feed_stream.latest_from_log(spark, log)


def stream_latest_state(spark, sf_dir):
    """T5 as keyed streaming state (update mode), read back as the current state."""
    masters = _masters_args(spark, sf_dir)
    log = feed_stream.stream_latest_state_to_log(spark, P.feed_csv_dir(spark, sf_dir), *masters,
                                                 bytes_per_trigger=BYTES_PER_TRIGGER)
    return feed_stream.latest_from_state_log(spark, log, *masters)


def stream_latest_compacted(spark, sf_dir):
    """A feed streamed in four micro-batches, compacted over the first
    two; keep-last per order from the snapshot and the batches behind it."""
    log, _ = feed_stream.stream_enrich_to_log(spark, P.feed_in_parts_dir(spark, sf_dir), *_masters_args(spark, sf_dir),
                                              files_per_trigger=P.feed_parts(spark, sf_dir) // 4)
    feed_stream.compact_log(spark, log, through=1)
    return feed_stream.latest_compacted(spark, log)


QUERIES: dict[str, Query] = {
    "scan_transactions": scan_transactions,
    "ingest_ledger": ingest_ledger,
    "scan_masters": scan_masters,
    "scan_product_master": scan_product_master,
    "clean_transactions": clean_transactions,
    "quarantine": quarantine,
    "clean_money": clean_money,
    "enrich_sales": enrich_sales,
    "master_first_match": master_first_match,
    "unmatched_transactions": unmatched_transactions,
    "enrich_product_master": enrich_product_master,
    "enrich_dirty_prices": enrich_dirty_prices,
    "latest_per_order": latest_per_order,
    "latest_by_arrival": latest_by_arrival,
    "sink_enriched_csv": sink_enriched_csv,
    "scan_enriched": scan_enriched,
    "load_staging": load_staging,
    "staging_preview": staging_preview,
    "dim_time": _wh_table("time_dim"),
    "dim_product": _wh_table("product"),
    "dim_customer": _wh_table("customer"),
    "dim_store": _wh_table("store"),
    "dim_supplier": _wh_table("supplier"),
    "build_fact": build_fact,
    "load_sales": _loaded_table("sales"),
    "load_time": _loaded_table("time_dim"),
    "load_product": _loaded_table("product"),
    "load_customer": _loaded_table("customer"),
    "load_store": _loaded_table("store"),
    "load_supplier": _loaded_table("supplier"),
    "load_view": load_view,
    "load_q1": load_q1,
    "check_primary_keys": check_primary_keys,
    "check_foreign_keys": check_foreign_keys,
    "check_foreign_keys_bitmap": check_foreign_keys_bitmap,
    "dense_order_date": _dense_keys("order_date"),
    "dense_product_id": _dense_keys("product_id"),
    "fact_clustered": fact_clustered,
    "check_not_null": check_not_null,
    "supplier_count": supplier_count,
    "q1": _olap(olap.q1),
    "q1_top5_each": _olap(olap.q1_top5_each),
    "q2": _olap(olap.q2),
    "q3": _olap(olap.q3),
    "q4": _olap(olap.q4),
    "q5": _olap(olap.q5),
    "q6": _olap(olap.q6),
    "q6_lines": q6_lines,
    "q7": _olap(olap.q7),
    "q8": _olap(olap.q8),
    "q9": _olap(olap.q9),
    "q10": _olap(olap.q10),
    "stream_enrich": stream_enrich,
    "stream_latest_per_order": stream_latest_per_order,
    "stream_latest_by_arrival": stream_latest_by_arrival,
    "stream_latest_state": stream_latest_state,
    "stream_latest_compacted": stream_latest_compacted,
}
