"""Enrichment of the transaction feed with master data.

A feed line is *matched* when its customer and its product exist in the
masters (and, where the supplier rides on the line, its supplier and that
supplier's store).  Unmatched lines are dropped from the enriched output and
reported by :func:`unmatched`.  When a master holds one key twice, the first
row in the stated order wins (:func:`first_match`).  Per order, the last
*matched* line wins (:func:`latest_per_order`); an unmatched later line
replaces nothing.

"Last" is the line number where a line has one, else the arrival taken at the
scan (``starling.sources.feed_csv``); product, supplier and quantity break ties.

A missing price sells at 0.00.  A line whose total does not fit the money type
is treated like an unmatched one: dropped, and reported by
:func:`oversized`.

Every lookup is an inner equi-join with the deduplicated master.  The dedupe
ends in a shuffle whose size Spark measures, so adaptive execution broadcasts a
small master and joins a large one by sort-merge, splitting a skewed key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from starling.operators.keep import keep_first, keep_last
from starling.schema import ARRIVAL, ENRICHED_COLUMNS, MONEY

# Order of lines within an order: the last line is the greatest in this order.
LINE_ORDER = ["line_number", ARRIVAL, "product_id", "supplier_id", "quantity"]
ORDER_COLUMNS = ("line_number", ARRIVAL)

CUSTOMER_COLUMNS = ["customer_id", "customer_name", "gender"]
PRODUCT_COLUMNS = ["product_id", "product_name", "product_price"]
SUPPLIER_COLUMNS = ["supplier_id", "supplier_name", "store_id"]
STORE_COLUMNS = ["store_id", "store_name"]
PRODUCT_WITH_SUPPLIER = PRODUCT_COLUMNS + ["supplier_id", "supplier_name", "store_id", "store_name"]


def first_match(master: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """One master row per key: the least in ``order`` (default: the other columns in turn)."""
    order = order if order is not None else [c for c in master.columns if c != key]
    return keep_first(master, key, order)


def total_sale(quantity="quantity", price="product_price"):
    """Quantity times price; 0.00 without a price, NULL when it does not fit the money type."""
    q = F.col(quantity) if isinstance(quantity, str) else quantity
    p = F.col(price) if isinstance(price, str) else price
    return (q * F.coalesce(p, F.lit(0).cast(MONEY))).try_cast(MONEY)


def lookup(master: DataFrame, key: str, unique: bool = False) -> DataFrame:
    """A master as a join side: one row per key."""
    return master if unique else first_match(master, key)


@dataclass(frozen=True)
class Lookups:
    """The masters as join sides: one row per key."""

    customers: DataFrame | None
    products: DataFrame
    suppliers: DataFrame | None = None
    stores: DataFrame | None = None


def prepare(customers: DataFrame | None, products: DataFrame, suppliers: DataFrame | None = None,
            stores: DataFrame | None = None, masters_unique: bool = False) -> Lookups:
    """Dedupe the masters (first match).

    With ``suppliers`` given, the line carries ``supplier_id`` and the store is
    the supplier's.  Without it, the product master carries supplier and store
    (the warehouse's own master layout).
    """
    sides = [(customers, CUSTOMER_COLUMNS, "customer_id")]
    if suppliers is None:
        sides += [(products, PRODUCT_WITH_SUPPLIER, "product_id"), (None, None, None), (None, None, None)]
    else:
        sides += [(products, PRODUCT_COLUMNS, "product_id"), (suppliers, SUPPLIER_COLUMNS, "supplier_id"),
                  (stores, STORE_COLUMNS, "store_id")]

    def one(side):
        df, cols, key = side
        return None if df is None else lookup(df.select(*cols), key, masters_unique)

    return Lookups(*map(one, sides))


def _match(lines: DataFrame, lk: Lookups) -> DataFrame:
    if lk.suppliers is None:
        # the product's supplier replaces any supplier on the line
        base = lines.drop("supplier_id") if "supplier_id" in lines.columns else lines
        return base.join(lk.products, "product_id")
    return lines.join(lk.products, "product_id").join(lk.suppliers, "supplier_id").join(lk.stores, "store_id")


def match_lines(lines: DataFrame, products: DataFrame, suppliers: DataFrame | None = None,
                stores: DataFrame | None = None, masters_unique: bool = False) -> DataFrame:
    """Line-level lookups: product, and supplier and store (see :func:`prepare`)."""
    return _match(lines, prepare(None, products, suppliers, stores, masters_unique))


def _with_total(df: DataFrame) -> DataFrame:
    """Matched lines with their total; oversized ones (NULL total) are still there."""
    return df.withColumn("total_sale", total_sale())


def _enriched(feed: DataFrame, lk: Lookups) -> DataFrame:
    return _with_total(_match(feed, lk).join(lk.customers, "customer_id"))


def _enriched_columns(matched: DataFrame, keep_order_columns: bool) -> DataFrame:
    out = matched.where(F.col("total_sale").isNotNull()).withColumnRenamed("quantity", "quantity_ordered")
    extra = [c for c in ORDER_COLUMNS if keep_order_columns and c in out.columns]
    return out.select(*ENRICHED_COLUMNS, *extra)


def enrich(feed: DataFrame, customers: DataFrame | None = None, products: DataFrame | None = None,
           suppliers: DataFrame | None = None, stores: DataFrame | None = None,
           keep_order_columns: bool = False, masters_unique: bool = False,
           lookups: Lookups | None = None) -> DataFrame:
    """Every matched feed line with its 14 enriched columns (line grain).

    ``masters_unique`` skips the first-match dedupe for masters that were
    already reduced to one row per key (see :func:`unique_masters`);
    ``lookups`` passes masters prepared once by :func:`prepare` instead.
    ``keep_order_columns`` keeps line number and arrival, where the feed has them.
    """
    lk = lookups or prepare(customers, products, suppliers, stores, masters_unique)
    return _enriched_columns(_enriched(feed, lk), keep_order_columns)


def oversized(feed: DataFrame, customers: DataFrame, products: DataFrame, suppliers: DataFrame | None = None,
              stores: DataFrame | None = None) -> DataFrame:
    """Matched feed lines whose total does not fit the money type, with the reason."""
    out = _enriched(feed, prepare(customers, products, suppliers, stores))
    return out.where(F.col("total_sale").isNull()).select(
        *[c for c in feed.columns if c in out.columns], F.lit("total out of range").alias("reason"))


def line_order(columns: list[str], quantity: str = "quantity_ordered") -> list[str]:
    """The order of lines for a table with ``columns``; it needs a line number or an arrival."""
    if not any(c in columns for c in ORDER_COLUMNS):
        raise ValueError(f"the last line of an order needs one of {ORDER_COLUMNS}")
    return [c for c in [*LINE_ORDER[:-1], quantity] if c in columns]


def latest_per_order(enriched: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Keep-last per order over matched lines, in the 14 staging columns.

    ``enriched`` must carry ordering columns (``enrich(keep_order_columns=True)``).
    """
    return keep_last(enriched, "order_id", order or line_order(enriched.columns)).select(*ENRICHED_COLUMNS)


def _matched_line_keys(lines: DataFrame, lookups: Lookups) -> DataFrame:
    """The lines that their product, supplier and store match and whose total fits, decided with key columns
    and the price only; the supplier is that of the match."""
    narrow = _match(lines, Lookups(None, *[
        None if m is None else m.select(*[c for c in m.columns if c in keep]) for m, keep in (
            (lookups.products, {"product_id", "product_price", "supplier_id", "store_id"}),
            (lookups.suppliers, {"supplier_id", "store_id"}), (lookups.stores, {"store_id"}))]))
    return narrow.where(total_sale().isNotNull()).select(*lines.columns)


def matched_keys(feed: DataFrame, lookups: Lookups) -> DataFrame:
    """The feed lines that :func:`enrich` keeps (see :func:`_matched_line_keys`)."""
    return _matched_line_keys(feed, lookups).join(
        lookups.customers.select("customer_id"), "customer_id", "left_semi").select(*feed.columns)


def enrich_parts(lines: DataFrame, headers: DataFrame, lookups: Lookups, keep_order_columns: bool = False) -> DataFrame:
    """:func:`enrich` of ``lines`` joined with ``headers`` (date and customer of an order).

    The customer belongs to the order, so its name is joined to the headers, a
    row per order, and the lines are shuffled by order once, not by order and
    again by customer with every name on them.
    """
    return _enriched_columns(_with_total(_match(lines, lookups)).join(
        headers.join(lookups.customers, "customer_id"), "order_id"), keep_order_columns)


def latest_lines(feed: DataFrame, lookups: Lookups) -> DataFrame:
    """Staging rows of a feed, with the keep-last on narrow rows.

    The last matched line of every order is picked from ids, quantity and
    ordering columns, and only the winners, one row per order, meet the
    masters' names.
    """
    matched = matched_keys(feed, lookups)
    return enrich(keep_last(matched, "order_id", line_order(feed.columns, "quantity")), lookups=lookups)


def staging_from_parts(lines: DataFrame, headers: DataFrame, customers: DataFrame | None = None,
                       products: DataFrame | None = None, suppliers: DataFrame | None = None,
                       stores: DataFrame | None = None, lookups: Lookups | None = None) -> DataFrame:
    """Keep-last staging rows when date and customer are order-level attributes.

    If every line of an order shares the order's date and customer (true when
    they come from an order header table), matching the customer is a
    property of the whole order.  So the last line is picked among the
    line-matched lines first, by key columns and the price only, and only one
    row per order meets the names, the header and the customer master: the
    widest joins run on a quarter of the rows and those by order are
    one-to-one, so a hot order cannot skew them.  ``headers`` must hold
    one row per order (its key), as an order table does.
    """
    lk = lookups or prepare(customers, products, suppliers, stores)
    matched = _matched_line_keys(lines, lk)
    return enrich_parts(keep_last(matched, "order_id", line_order(lines.columns, "quantity")), headers, lk)


def unmatched(feed: DataFrame, customers: DataFrame, products: DataFrame,
              suppliers: DataFrame | None = None, stores: DataFrame | None = None) -> DataFrame:
    """Feed lines that the enrichment drops, with the first lookup that failed.

    The lookups are left joins against the same first-match masters the
    enrichment uses, so a line is reported exactly when :func:`enrich` drops it.
    """
    def keys(df, key, flag):
        return df.select(key).distinct().withColumn(flag, F.lit(True))

    x = (feed.join(keys(customers, "customer_id", "_c"), "customer_id", "left")
         .join(keys(products, "product_id", "_p"), "product_id", "left"))
    reason = (F.when(F.col("_c").isNull(), F.lit("unknown customer"))
              .when(F.col("_p").isNull(), F.lit("unknown product")))
    if suppliers is not None:
        # the store of a supplier is the store of its first-match row
        sup = first_match(suppliers.select(*SUPPLIER_COLUMNS), "supplier_id").select(
            "supplier_id", F.col("store_id").alias("_store_of_supplier"), F.lit(True).alias("_s"))
        st = keys(stores, "store_id", "_st").withColumnRenamed("store_id", "_store_of_supplier")
        x = x.join(sup, "supplier_id", "left").join(st, "_store_of_supplier", "left")
        reason = (reason.when(F.col("_s").isNull(), F.lit("unknown supplier"))
                  .when(F.col("_st").isNull(), F.lit("unknown store")))
    return x.withColumn("reason", reason).where(F.col("reason").isNotNull()).select(
        *feed.columns, "reason")


def unique_masters(customers: DataFrame, products: DataFrame, suppliers: DataFrame | None,
                   stores: DataFrame | None) -> list[DataFrame | None]:
    """The masters reduced to one row per key (first match), as lazy DataFrames."""
    out = [first_match(customers.select(*CUSTOMER_COLUMNS), "customer_id")]
    if suppliers is None:
        out += [first_match(products.select(*PRODUCT_WITH_SUPPLIER), "product_id"), None, None]
    else:
        out += [first_match(products.select(*PRODUCT_COLUMNS), "product_id"),
                first_match(suppliers.select(*SUPPLIER_COLUMNS), "supplier_id"),
                first_match(stores.select(*STORE_COLUMNS), "store_id")]
    return out
