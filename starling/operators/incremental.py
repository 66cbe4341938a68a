"""Incremental load of the warehouse (S9, K1 to K6, K10) and views with retractions.

The full build (:class:`starling.operators.warehouse.Warehouse`) reads all of
staging.  Here the enriched lines arrive in batches, kept in a
:class:`BatchLog`, and a load works on what a batch changes:

1. the batch's lines are reduced to one per order and meet the present row of
   those orders only; the result, written once, holds ``old`` and ``new`` of
   every order that changed (``old`` is NULL for a new order);
2. dimensions and the revenue view are *grouped views*: their state counts rows
   and adds up measures per group.  A changed order adds its new row and
   subtracts its old one, so a product that no order names any more leaves its
   dimension, and revenue moves from one quarter to another.  A load writes the
   groups it changes as one more piece; readers add the pieces up;
3. the fact is kept in periods (months).  New orders are one more piece of their
   period; only periods that hold an ``old`` row are written again.

A version of the warehouse is a manifest, a small file that lists the pieces of
every table, and an empty file whose creation commits it.  Nothing is
overwritten or renamed, readers see whole versions, and a load that died is
repeated from the log.  Beyond ``max_pieces`` pieces a view or a period is
written as one again.  One writer at a time; a second one is told.

The driver handles the names of periods and pieces, never rows.

Defined cases: a batch loaded twice changes nothing the second time; a late line
that does not win changes nothing; an empty batch commits a version without new
pieces; rows with a NULL key or date stay out of the fact and out of revenue as
in the full build; a key with different rows in a dimension fails the load before
its commit, and the version before stays.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from starling.functions import arithmetic
from starling.operators import enrich as E
from starling.operators.keep import keep_last
from starling.operators.warehouse import DIMENSIONS, build_fact_derived
from starling.schema import ENRICHED, ENRICHED_COLUMNS, MONEY_SUM, PRIMARY_KEYS, SALES
from starling.streaming.batch_log import BatchLog
from starling.streaming.feed_stream import LOG_SCHEMA

_SIGN, _ROWS, _PERIOD = "__sign", "__rows", "period"
_DIGITS = 20


@dataclass(frozen=True)
class GroupedView:
    """Rows counted and measures added up per group of staging rows.

    ``rows`` maps staging rows to the columns of ``keys`` and ``sums`` (it may
    drop rows, and must not look beyond one row); ``sums`` are money columns.
    """

    name: str
    keys: tuple[str, ...]
    rows: Callable[[DataFrame], DataFrame]
    sums: tuple[str, ...] = ()

    def _values(self) -> list[str]:
        return [_ROWS, *[f"{kind}_{c}" for c in self.sums for kind in ("sum", "n")]]

    def delta(self, signed: DataFrame) -> DataFrame:
        """What rows with a sign add to the state of their groups; groups without a change are left out."""
        sign = F.col(_SIGN)
        aggs = [F.sum(sign).cast("long").alias(_ROWS)]
        for c in self.sums:
            aggs += [F.sum(F.coalesce(F.col(c).cast(MONEY_SUM) * sign.cast("decimal(1,0)"), F.lit(0))).cast(MONEY_SUM).alias(f"sum_{c}"),
                     F.sum(F.when(F.col(c).isNotNull(), sign).otherwise(0)).cast("long").alias(f"n_{c}")]
        changed = F.lit(False)
        for v in self._values():
            changed = changed | (F.col(v) != 0)
        return self.rows(signed).groupBy(*self.keys).agg(*aggs).where(changed)

    def add_up(self, pieces: DataFrame) -> DataFrame:
        """One row per group over pieces of the state, the groups that still have rows."""
        aggs = [F.sum(v).cast(MONEY_SUM if v.startswith("sum_") else "long").alias(v) for v in self._values()]
        return pieces.groupBy(*self.keys).agg(*aggs).where(F.col(_ROWS) > 0)

    def result(self, state: DataFrame) -> DataFrame:
        """The view as a user reads it: keys, ``rows`` and the sums (NULL where a group has no value)."""
        return state.select(*self.keys, F.col(_ROWS).alias("rows"), *[
            F.when(F.col(f"n_{c}") > 0, F.col(f"sum_{c}")).alias(c) for c in self.sums])


def _columns(*names: str) -> Callable[[DataFrame], DataFrame]:
    return lambda rows: rows.select(_SIGN, *names)


def _days(rows: DataFrame) -> DataFrame:
    day = F.to_date("order_date").cast("timestamp_ntz")
    return rows.select(_SIGN, day.alias("order_date")).where(F.col("order_date").isNotNull())


def _in_fact(rows: DataFrame) -> DataFrame:
    """The staging rows that :func:`build_fact_derived` takes."""
    for c in ("order_date", "product_id", "customer_id", "store_id", "supplier_id"):
        rows = rows.where(F.col(c).isNotNull())
    return rows


def _quarters(rows: DataFrame) -> DataFrame:
    return _in_fact(rows).select(_SIGN, "store_id", "store_name", F.year("order_date").alias("year"),
                                 F.quarter("order_date").alias("quarter"), "total_sale")


_DIMENSION_COLUMNS = {
    "product": ("product_id", "product_name", "product_price"),
    "customer": ("customer_id", "customer_name", "gender"),
    "store": ("store_id", "store_name"),
    "supplier": ("supplier_id", "supplier_name"),
}
# A dimension's view holds the columns of staging that the dimension is made of.
DIMENSION_VIEWS = {
    "time_dim": GroupedView("time_dim", ("order_date",), _days),
    **{name: GroupedView(name, columns, _columns(*columns)) for name, columns in _DIMENSION_COLUMNS.items()},
}
# K5 keeps the least of several names, so a supplier has no conflict; a date is its own attributes.
CONFLICTING = ("product", "customer", "store")
QUARTERS = GroupedView("store_quarters", ("store_id", "store_name", "year", "quarter"), _quarters, ("total_sale",))


class IncrementalWarehouse:
    """The warehouse at ``root``, loaded batch by batch.

    It serves ``table(name)`` and ``dim(name)`` as :class:`Warehouse` does, so
    the OLAP queries run on it unchanged.  ``views`` are kept besides the
    dimensions and :data:`QUARTERS`.
    """

    def __init__(self, spark: SparkSession, root: str, views: Sequence[GroupedView] = (), max_pieces: int = 16,
                 lines_schema: T.StructType = LOG_SCHEMA):
        self.spark, self.root, self.max_pieces = spark, root.rstrip("/"), max_pieces
        self.log = BatchLog(spark, f"{self.root}/lines", lines_schema, bucket_by="order_id")
        self.order = E.line_order(lines_schema.fieldNames())
        self.views = {**DIMENSION_VIEWS, **{v.name: v for v in (QUARTERS, *views)}}

    # ------------------------------------------------------------------ versions
    def _path(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _names(self, folder: str) -> list[str]:
        fs, path = self._path(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def _manifest(self) -> dict:
        """The newest committed version; of two commits of one version the first name counts."""
        commits: dict[int, str] = {}
        for name in self._names("_versions"):
            commits.setdefault(int(name.split("-")[0]), name)
        if not commits:
            return {"version": -1, "views": {}, "sales": {}}
        fs, path = self._path(f"_manifests/{commits[max(commits)]}")
        stream = fs.open(path)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, manifest: dict, attempt: str) -> None:
        name = f"{manifest['version']:0{_DIGITS}d}-{attempt}"
        fs, path = self._path(f"_manifests/{name}")
        out = fs.create(path, False)
        try:
            out.write(json.dumps(manifest).encode())
        finally:
            out.close()
        fs, path = self._path(f"_versions/{name}")
        if not fs.createNewFile(path) or self._manifest()["attempt"] != attempt:
            raise RuntimeError(f"another writer committed version {manifest['version']} of {self.root}")

    def version(self) -> int:
        """The last batch that the tables hold; -1 before the first."""
        return self._manifest()["version"]

    # ------------------------------------------------------------------ readers
    def _pieces(self, paths: Sequence[str], schema: T.StructType) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{p}" for p in paths])

    def _state_schema(self, view: GroupedView) -> T.StructType:
        none = self.spark.createDataFrame([], ENRICHED).withColumn(_SIGN, F.lit(1))
        return view.delta(none).schema

    def _state(self, view: GroupedView, paths: Sequence[str]) -> DataFrame:
        return self._pieces(paths, self._state_schema(view))

    def view(self, name: str) -> DataFrame:
        """A grouped view: its keys, ``rows`` and sums."""
        view = self.views[name]
        return view.result(view.add_up(self._state(view, self._manifest()["views"].get(name, []))))

    def sales(self, periods: Sequence[int] | None = None) -> DataFrame:
        """The fact, or the given periods (``yyyyMM``) of it."""
        listed = self._manifest()["sales"]
        return self._pieces([p for k, paths in sorted(listed.items()) if periods is None or int(k) in periods
                             for p in paths], SALES)

    def staging(self) -> DataFrame:
        """The last line of every order that the tables hold."""
        return self.log.latest("order_id", self.order, self.version()).select(*ENRICHED_COLUMNS)

    def table(self, name: str) -> DataFrame:
        if name == "staging":
            return self.staging()
        return self.sales() if name == "sales" else DIMENSIONS[name](self.view(name))

    def dim(self, name: str) -> DataFrame:
        return self.table(name)

    def store_quarterly_sales(self) -> DataFrame:
        """K10, Q10 from its view: store revenue by year and quarter."""
        return self.view(QUARTERS.name).groupBy("store_name", "year", "quarter").agg(
            arithmetic.money_sum("total_sale").alias("total_quarterly_sales")).orderBy("store_name", "year", "quarter")

    # ------------------------------------------------------------------ loads
    def load(self, lines: DataFrame, batch_id: int, dealt: bool = False) -> bool:
        """Log a batch of enriched lines and bring the tables up to it; False when it was loaded before.

        The log keeps the lines bucketed by order; ``dealt`` lines come dealt out by order and are not shuffled for it.
        """
        logged = self.log.append(lines.select(*self.log.schema.fieldNames()), batch_id, dealt)
        return self.refresh() is not None or logged

    def _changes(self, after: int, through: int) -> DataFrame:
        """order_id, old, new of the orders whose staging row the batches change."""
        rest = [c for c in self.log.schema.fieldNames() if c != "order_id" and c not in self.order]
        packed = F.struct(*self.order, *rest)
        batch = keep_last(self.log.read(after, through).select(*self.log.schema.fieldNames()), "order_id", self.order)
        new = batch.select("order_id", packed.alias("new"))
        if after < 0:
            both = new.withColumn("old", F.lit(None).cast(new.schema["new"].dataType))
        else:
            old = self.log.latest("order_id", self.order, after, of=batch.select("order_id"))
            both = new.join(old.select("order_id", packed.alias("old")), "order_id", "left")
        return both.where(F.col("old").isNull() | (F.col("new") > F.col("old"))).select("order_id", *[
            F.when(F.col(side).isNotNull(), F.struct(*[
                (F.col("order_id") if c == "order_id" else F.col(f"{side}.{c}")).alias(c)
                for c in ENRICHED_COLUMNS])).alias(side) for side in ("old", "new")])

    def _written(self, df: DataFrame, folder: str) -> DataFrame:
        df.write.parquet(f"{self.root}/{folder}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{folder}")

    def refresh(self) -> int | None:
        """Bring the tables up to the last batch of the log, as one version; None when they are."""
        now = self._manifest()
        last = max(self.log.committed(), default=-1)
        if last <= now["version"]:
            return None
        attempt = uuid.uuid4().hex
        tag = f"{last:0{_DIGITS}d}-{attempt}"
        changes = self._written(self._changes(now["version"], last), f"changes/{tag}")
        signed = changes.select(F.explode(F.array(
            F.struct(F.lit(-1).alias(_SIGN), F.col("old").alias("row")),
            F.struct(F.lit(1).alias(_SIGN), F.col("new").alias("row")))).alias("one")).where(
                F.col("one.row").isNotNull()).select(f"one.{_SIGN}", "one.row.*")
        manifest = {"version": last, "attempt": attempt, "views": {}, "sales": {}}
        # the tables do not depend on each other: their jobs run together
        with ThreadPoolExecutor(max_workers=len(self.views) + 1) as pool:
            sales = pool.submit(self._load_sales, changes, now["sales"], tag)
            views = {name: pool.submit(self._load_view, view, signed, now["views"].get(name, []), tag)
                     for name, view in self.views.items()}
            manifest["sales"] = sales.result()
            manifest["views"] = {name: job.result() for name, job in views.items()}
        self._commit(manifest, attempt)
        return last

    def _load_view(self, view: GroupedView, signed: DataFrame, pieces: list[str], tag: str) -> list[str]:
        piece = f"views/{view.name}/{tag}"
        delta = self._written(view.delta(signed), piece)
        pieces = [*pieces, piece]
        if view.name in CONFLICTING:
            key = PRIMARY_KEYS[view.name]
            touched = delta.where(F.col(_ROWS) > 0).select(key).distinct()
            rows = view.add_up(self._state(view, pieces).join(touched, key, "left_semi"))
            bad = rows.groupBy(key).count().where("count > 1").count()
            if bad:
                raise ValueError(f"load refused: {bad} keys of {view.name} have different rows")
        if len(pieces) > self.max_pieces:
            self._written(view.add_up(self._state(view, pieces)), f"{piece}-whole")
            return [f"{piece}-whole"]
        return pieces

    def _load_sales(self, changes: DataFrame, listed: dict[str, list[str]], tag: str) -> dict[str, list[str]]:
        def fact(side: str) -> DataFrame:
            rows = build_fact_derived(changes.where(F.col(side).isNotNull()).select(f"{side}.*"))
            return rows.withColumn(_PERIOD, F.expr("date_id div 100").cast("int"))

        gone = fact("old").select("transaction_id", _PERIOD)
        # at most one row per month of the calendar
        again = {str(r[0]) for r in gone.select(_PERIOD).distinct().collect()}
        again |= {p for p, pieces in listed.items() if len(pieces) >= self.max_pieces}
        rows = fact("new")
        stale = [p for k in sorted(again & listed.keys()) for p in listed[k]]
        if stale:
            kept = self._pieces(stale, SALES).withColumn(_PERIOD, F.expr("date_id div 100").cast("int"))
            rows = kept.join(gone, ["transaction_id", _PERIOD], "left_anti").select(*rows.columns).unionByName(rows)
        (rows.repartitionByRange(_PERIOD, "date_id", "transaction_id").sortWithinPartitions(_PERIOD, "date_id")
         .write.partitionBy(_PERIOD).parquet(f"{self.root}/sales/{tag}"))
        written = {n.split("=")[1] for n in self._names(f"sales/{tag}") if n.startswith(f"{_PERIOD}=")}
        out = {p: list(pieces) for p, pieces in listed.items() if p not in again}
        for p in written:
            out.setdefault(p, []).append(f"sales/{tag}/{_PERIOD}={p}")
        return out

    def compact(self) -> int | None:
        """Compact the log of lines up to the version of the tables (see :meth:`BatchLog.compact`)."""
        version = self.version()
        return self.log.compact("order_id", self.order, version) if version >= 0 else None

    def close(self) -> None:
        self.log.close()
