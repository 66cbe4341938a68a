"""Star schema construction (K1 to K6) and the materialised warehouse.

Dimensions come from the staging table by one grouping on their key (with a
map-side partial aggregate, so a hot value is collapsed before the shuffle)
that also counts conflicting rows.  For a bucketed dimension it is the only
shuffle: its partitioning is that of the buckets.
The time dimension's key is ``yyyyMMdd``: stable across runs, unlike an
auto-increment, and computable from a date without a lookup.

:class:`Warehouse` writes staging, dimensions and fact once as Parquet below
the session's checkpoint folder and serves them from there, so the queries
neither recompute the enrichment nor depend on a long lineage.
"""

from __future__ import annotations

import logging
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from starling.functions import calendar
from starling.operators.quality import assert_clean, check_foreign_keys, check_not_null, check_primary_keys
from starling.operators.sizing import bounded_broadcast, row_width
from starling.schema import (CUSTOMER_DIM, ENRICHED, PRIMARY_KEYS, PRODUCT_DIM, SALES, STORE_DIM,
                             SUPPLIER_DIM, TIME_DIM, conform)
from starling.session import scratch_dir
from starling.sources.tables import read_table, write_table


_CONFLICT = "__conflict"


def _by_key(rows: DataFrame, key: str) -> DataFrame:
    """One row per key (the least in the other columns), and whether the key has different rows."""
    rest = F.struct(*[c for c in rows.columns if c != key])
    return rows.groupBy(key).agg(F.min(rest).alias("a"), F.max(rest).alias("b")).select(
        key, "a.*", (~F.col("a").eqNullSafe(F.col("b"))).alias(_CONFLICT))


def _all_time(staging: DataFrame) -> DataFrame:
    dates = staging.select(F.to_date("order_date").alias("date")).where(F.col("date").isNotNull()).distinct()
    return dates.select(
        calendar.date_key("date").alias("date_id"),
        "date",
        calendar.day_name("date").alias("day"),
        calendar.month_name("date").alias("month"),
        F.year("date").alias("year"),
        calendar.is_weekend("date").alias("is_weekend"),
        F.lit(False).alias(_CONFLICT))


# Per dimension: its rows with the conflict flag, and the columns of the table.
_DIMENSION_ROWS = {
    "time_dim": (_all_time, TIME_DIM),
    "product": (lambda s: _by_key(s.select("product_id", "product_name", "product_price"), "product_id"), PRODUCT_DIM),
    "customer": (lambda s: _by_key(s.select("customer_id", "customer_name", "gender"), "customer_id"), CUSTOMER_DIM),
    "store": (lambda s: _by_key(s.select("store_id", "store_name"), "store_id"), STORE_DIM),
    # K5 keeps the least of several names of a supplier, so it has no conflict
    "supplier": (lambda s: _by_key(s.select("supplier_id", "supplier_name"), "supplier_id").withColumn(
        _CONFLICT, F.lit(False)), SUPPLIER_DIM),
}


def _distinct_dimension(staging: DataFrame, *cols: str, schema) -> DataFrame:
    return conform(staging.select(*cols).distinct(), schema)


def dim_time(staging: DataFrame) -> DataFrame:
    """K1: one row per calendar date of the staging data."""
    return conform(_all_time(staging), TIME_DIM)


def dim_product(staging: DataFrame) -> DataFrame:
    """K2: distinct (id, name, price); a conflicting id is caught by the key check."""
    return _distinct_dimension(staging, "product_id", "product_name", "product_price", schema=PRODUCT_DIM)


def dim_customer(staging: DataFrame) -> DataFrame:
    """K3."""
    return _distinct_dimension(staging, "customer_id", "customer_name", "gender", schema=CUSTOMER_DIM)


def dim_store(staging: DataFrame) -> DataFrame:
    """K4."""
    return _distinct_dimension(staging, "store_id", "store_name", schema=STORE_DIM)


def dim_supplier(staging: DataFrame) -> DataFrame:
    """K5: one row per supplier id; of several names the least is kept."""
    return conform(staging.groupBy("supplier_id").agg(F.min("supplier_name").alias("supplier_name")),
                   SUPPLIER_DIM)


def _fact_columns(df: DataFrame) -> DataFrame:
    return conform(df.select(
        F.col("order_id").alias("transaction_id"), "date_id", "product_id", "customer_id",
        "store_id", "supplier_id", F.col("quantity_ordered").alias("quantity"), "total_sale"), SALES)


def build_fact(staging: DataFrame, time_dim: DataFrame, product: DataFrame, customer: DataFrame,
               store: DataFrame, supplier: DataFrame) -> DataFrame:
    """K6: the fact, checked against the dimensions by joins.

    The date join is an inner join on the derived date; the other four are
    existence checks, written as ``left_semi`` (the dimension keys are unique,
    so this equals the inner join and cannot multiply rows).
    """
    t = time_dim.select("date", "date_id")
    st = store.select("store_id")
    f = (staging.withColumn("date", F.to_date("order_date"))
         .join(t, "date")
         .join(product.select("product_id"), "product_id", "left_semi")
         .join(customer.select("customer_id"), "customer_id", "left_semi")
         .join(st, "store_id", "left_semi")
         .join(supplier.select("supplier_id"), "supplier_id", "left_semi"))
    return _fact_columns(f)


def build_fact_derived(staging: DataFrame) -> DataFrame:
    """K6 when the dimensions were built from this same staging table.

    Then every non-NULL key of the staging rows is in its dimension by
    construction, the four existence joins keep exactly the rows whose keys
    are not NULL, and the date key is computed from the date.  Same rows as
    :func:`build_fact`, without five joins over the largest table.
    """
    keys = ["product_id", "customer_id", "store_id", "supplier_id"]
    f = staging.where(F.col("order_date").isNotNull())
    for k in keys:
        f = f.where(F.col(k).isNotNull())
    f = f.withColumn("date_id", calendar.date_key(F.to_date("order_date")))
    return _fact_columns(f)


def cluster_by_date(fact: DataFrame) -> DataFrame:
    """Range-partition the fact by (``date_id``, ``transaction_id``) and sort
    each partition, so every file and row group covers a narrow date range:
    a ``date_id`` range filter then skips files by their statistics.  The
    second key splits a hot day over several files."""
    return fact.repartitionByRange("date_id", "transaction_id").sortWithinPartitions("date_id")


DIMENSIONS = {
    "time_dim": dim_time,
    "product": dim_product,
    "customer": dim_customer,
    "store": dim_store,
    "supplier": dim_supplier,
}


TABLE_SCHEMAS = {"staging": ENRICHED, "sales": SALES, "sales_lines": SALES,
                 **{name: schema for name, (_, schema) in _DIMENSION_ROWS.items()}}

# Dimensions that grow with the data and that queries join by key, written
# bucketed: a query that cannot broadcast one joins it without shuffling it.
BUCKETED_DIMENSIONS = {"product": "product_id", "supplier": "supplier_id"}

_LOG = logging.getLogger(__name__)


def catalog_usable(spark: SparkSession) -> bool:
    """Whether the session's catalog answers; if not, the reason is logged."""
    try:
        spark.catalog.listTables()
    except AnalysisException as e:
        _LOG.warning("no usable catalog, tables are written without buckets: %s", e)
        return False
    return True


def save_bucketed(spark: SparkSession, df: DataFrame, path: str, key: str, catalog_name: str,
                  buckets: int | None = None) -> bool:
    """Write ``df`` bucketed and sorted by ``key`` (default: as many buckets as shuffle
    partitions) as an external table; False when there is no catalog to hold it.  A write that fails raises: it is not tried again in another form."""
    if not catalog_usable(spark):
        return False
    # df comes from a grouping by the key, whose partitions are the buckets (adaptive
    # execution only joins whole ones): each bucket is one file without another shuffle
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(catalog_name))
    return True


@dataclass
class Warehouse:
    """Materialised warehouse tables, read back from Parquet.

    Product and supplier are written bucketed and sorted by key (external
    tables at ``root``, registered under unique names in the session catalog
    until :meth:`close`).  When one of them is too large to broadcast, the
    other side of the join is shuffled into its buckets, never the dimension.
    """

    spark: SparkSession
    root: str
    paths: dict[str, str] = field(default_factory=dict)
    sizes: dict[str, tuple[int, int]] = field(default_factory=dict)
    catalog_names: dict[str, str] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        if name in self.catalog_names:
            return self.spark.table(self.catalog_names[name])
        return read_table(self.spark, self.paths[name], TABLE_SCHEMAS.get(name))

    def dim(self, name: str, max_bytes: int | None = None) -> DataFrame:
        """A dimension, broadcast when its recorded size fits the budget."""
        return bounded_broadcast(self.table(name), self.sizes.get(name), max_bytes)

    def save(self, name: str, df: DataFrame, bucket_by: str | None = None) -> DataFrame:
        """Write ``df`` as table ``name``, conformed to its schema (bucketed by ``bucket_by`` if given)."""
        path = f"{self.root}/{name}"
        if name in TABLE_SCHEMAS:
            df = conform(df, TABLE_SCHEMAS[name])
        catalog_name = f"starling_{name}_{uuid.uuid4().hex[:12]}"
        if bucket_by is not None and save_bucketed(self.spark, df, path, bucket_by, catalog_name):
            self.catalog_names[name] = catalog_name
        else:
            write_table(df, path)
        self.paths[name] = path
        return self.table(name)

    def save_dimension(self, name: str, staging: DataFrame, check_key: bool = True,
                       bucket_by: str | None = None) -> None:
        """Write a dimension in one pass that also measures its size and counts
        keys with conflicting rows; such a key fails the build."""
        rows, _ = _DIMENSION_ROWS[name]
        seen = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
        df = rows(staging)
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"),
                        F.sum(row_width(df.drop(_CONFLICT).schema)).alias("bytes"),
                        F.count_if(F.col(_CONFLICT)).alias("conflicts"))
        self.save(name, df, bucket_by)
        got = seen.get
        self.sizes[name] = (int(got["rows"]), int(got["bytes"] or 0))
        if check_key and got["conflicts"]:
            raise ValueError(f"warehouse check failed: {got['conflicts']} keys of {name} have different rows")

    def close(self) -> None:
        """Take the bucketed tables out of the catalog; their files stay."""
        for name in list(self.catalog_names):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.catalog_names.pop(name)}")

    def register_views(self, prefix: str = "") -> list[str]:
        """Publish the tables as temporary views under the warehouse's table
        names (``output_data`` for staging), so SQL written against the
        warehouse runs on Spark as it is.  Column names match case-blind
        (``Total_Sale`` finds ``total_sale``)."""
        names = {"staging": "output_data", "time_dim": "time_dim", "product": "product",
                 "customer": "customer", "store": "store", "supplier": "supplier", "sales": "sales"}
        out = []
        for table, view in names.items():
            if table in self.paths:
                self.table(table).createOrReplaceTempView(prefix + view)
                out.append(prefix + view)
        return out

    @classmethod
    def build(cls, spark: SparkSession, staging: DataFrame, lines: DataFrame | None = None,
              root: str | None = None, check_keys: bool = True,
              bucketed: bool = True) -> "Warehouse":
        """Write staging, the five dimensions and the fact (and the line-grain
        sales when ``lines`` is given).

        With ``check_keys`` the build fails, as the constraints of the
        warehouse would, when a dimension key has different rows (a product id
        with two prices, say), when two fact rows share a transaction, when a
        fact key is not in its dimension, or when a time attribute is NULL.
        """
        wh = cls(spark, root or scratch_dir(spark, "warehouse"))
        stg = wh.save("staging", staging)
        # The dimensions and the fact are independent scans of the written
        # staging table: submit them as concurrent jobs of one application.
        with ThreadPoolExecutor(max_workers=len(DIMENSIONS) + 2) as pool:
            jobs = [pool.submit(wh.save_dimension, name, stg, check_keys,
                                BUCKETED_DIMENSIONS.get(name) if bucketed else None) for name in DIMENSIONS]
            jobs.append(pool.submit(wh.save, "sales", cluster_by_date(build_fact_derived(stg))))
            if lines is not None:
                jobs.append(pool.submit(wh.save, "sales_lines", lines))
            for job in jobs:
                job.result()
        if check_keys:
            wh.check_constraints()
        return wh

    def check_constraints(self) -> None:
        """K7 on the fact, K8 and K9 over the written tables; raises on a violation."""
        tables = {name: self.table(name) for name in [*DIMENSIONS, "sales"]}
        assert_clean(check_primary_keys(tables, {"sales": PRIMARY_KEYS["sales"]}), "duplicate_keys")
        assert_clean(check_foreign_keys(tables["sales"], tables), "orphan_rows")
        required = [f.name for f in TIME_DIM.fields if not f.nullable]
        assert_clean(check_not_null(tables["time_dim"], required), "null_rows")


class TableSet:
    """Warehouse tables given as DataFrames, for tests and ad-hoc use.

    ``from_staging`` derives the dimensions and the fact lazily, without
    writing anything.
    """

    def __init__(self, tables: dict[str, DataFrame]):
        self.tables = dict(tables)

    def table(self, name: str) -> DataFrame:
        return self.tables[name]

    def dim(self, name: str) -> DataFrame:
        return self.tables[name]

    @classmethod
    def from_staging(cls, staging: DataFrame) -> "TableSet":
        tables = {name: builder(staging) for name, builder in DIMENSIONS.items()}
        tables["staging"] = staging
        tables["sales"] = build_fact_derived(staging)
        return cls(tables)
