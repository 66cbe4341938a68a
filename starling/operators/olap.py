"""The ten OLAP questions over the star schema (Q1 to Q10), plus one variant.

Each function takes a table source with ``table(name)`` and ``dim(name)``
(``dim`` returns the dimension broadcast when it is provably small) and
returns a lazy DataFrame.

Plan shape.  Questions whose ids are few (Q1, Q2, Q4, Q5, Q8 to Q10) aggregate
the fact on its integer keys first, with a map-side partial aggregate and one
shuffle of the reduced rows; names are joined to those rows and, where the
question groups by name, aggregated again.  Q3 and Q7 group by store, supplier
and product together, which hardly reduces the fact, so they join the names
first and aggregate once.  Q6 is a self-join that names its few result rows.
The time and store dimensions are bounded by the calendar and the store count;
product and supplier dimensions grow with the data and are left to Spark's
size threshold.
"""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, Window, functions as F

from starling.functions import arithmetic, calendar
from starling.operators import pairs as basket_pairs
from starling.schema import MONEY_SUM, RATIO

DEFAULT_YEAR = 1997


class TableSource(Protocol):
    """Where the queries read the star schema: ``Warehouse`` or ``TableSet``."""

    def table(self, name: str) -> DataFrame: ...

    def dim(self, name: str) -> DataFrame: ...


def _sales(src: TableSource, *cols) -> DataFrame:
    return src.table("sales").select(*cols)


def _sales_of_year(src: TableSource, year: int, *cols) -> DataFrame:
    """Fact rows of one year.  ``date_id`` is ``yyyyMMdd``, so the year is a
    ``date_id`` range: a filter Parquet applies at the scan (the time
    dimension join below still decides which rows count)."""
    return src.table("sales").where(
        F.col("date_id").between(year * 10000 + 101, year * 10000 + 1231)).select(*cols)


def _names(src: TableSource, name: str, key: str, value: str) -> DataFrame:
    return src.dim(name).select(key, value)


def q1_revenue(src: TableSource, year: int = DEFAULT_YEAR) -> DataFrame:
    """Revenue per month, product name and weekend flag within one year."""
    t = src.dim("time_dim").where(F.col("year") == year).select(
        "date_id", F.month("date").alias("month"), "is_weekend")
    by_id = (_sales_of_year(src, year, "date_id", "product_id", "total_sale").join(t, "date_id")
             .groupBy("month", "is_weekend", "product_id").agg(F.sum("total_sale").alias("rev")))
    return (by_id.join(_names(src, "product", "product_id", "product_name"), "product_id")
            .groupBy("month", "product_name", "is_weekend")
            .agg(arithmetic.money_sum("rev").alias("total_revenue"))
            .select(F.col("month").cast("int").alias("month"), "product_name", "total_revenue", "is_weekend"))


def q1(src: TableSource, year: int = DEFAULT_YEAR, k: int = 5) -> DataFrame:
    """Q1: the first ``k`` rows in (month, weekend flag, revenue desc) order.

    The order sorts month and flag before revenue, so the rows come from the
    first month's weekdays; ``product_name`` breaks ties.
    """
    return q1_revenue(src, year).orderBy(
        F.col("month").asc(), F.col("is_weekend").asc(), F.col("total_revenue").desc(),
        F.col("product_name").asc()).limit(k)


def q1_top5_each(src: TableSource, year: int = DEFAULT_YEAR, k: int = 5) -> DataFrame:
    """Variant of Q1: the top ``k`` products of every (month, weekend flag).

    ``row_number() <= k`` lets Spark insert a partial per-group limit before
    the shuffle, so each group moves at most ``k`` rows per map task.
    """
    w = Window.partitionBy("month", "is_weekend").orderBy(
        F.col("total_revenue").desc(), F.col("product_name").asc())
    return (q1_revenue(src, year).withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= k).drop("_rn")
            .orderBy("month", "is_weekend", F.col("total_revenue").desc(), "product_name"))


def q2(src: TableSource, year: int = DEFAULT_YEAR) -> DataFrame:
    """Q2: store revenue per quarter of one year and growth over the previous row.

    ``lag`` follows the previous existing quarter of the same store name.
    """
    t = src.dim("time_dim").where(F.col("year") == year).select(
        "date_id", F.quarter("date").alias("q"))
    per_store = (_sales_of_year(src, year, "date_id", "store_id", "total_sale").join(t, "date_id")
                 .groupBy("store_id", "q").agg(arithmetic.money_sum("total_sale").alias("total_revenue"))
                 .join(_names(src, "store", "store_id", "store_name"), "store_id"))
    # store_id only breaks ties between two stores that share a name
    w = Window.partitionBy("store_name").orderBy("q", "store_id")
    prev = F.lag("total_revenue").over(w)
    return (per_store.select(
        "store_name",
        F.concat(F.lit("Q"), F.col("q").cast("string")).alias("quarter"),
        "total_revenue",
        arithmetic.change_pct_rounded(F.col("total_revenue"), prev, 2).alias("growth_rate"))
        .orderBy("store_name", "quarter"))


def _named_sales(src: TableSource, *cols) -> DataFrame:
    """Fact rows with store, supplier and product names.

    Grouping by all three ids first would save almost no rows for a shuffle of
    the whole fact, so the names are joined to the raw rows.
    """
    return (_sales(src, "store_id", "supplier_id", "product_id", *cols)
            .join(_names(src, "store", "store_id", "store_name"), "store_id")
            .join(_names(src, "supplier", "supplier_id", "supplier_name"), "supplier_id")
            .join(_names(src, "product", "product_id", "product_name"), "product_id"))


def q3(src: TableSource) -> DataFrame:
    """Q3: revenue by store, supplier and product names (equal names merge)."""
    return (_named_sales(src, "total_sale").groupBy("store_name", "supplier_name", "product_name")
            .agg(arithmetic.money_sum("total_sale").alias("total_contribution"))
            .orderBy(F.col("store_name").asc(), F.col("supplier_name").asc(),
                     F.col("total_contribution").desc()))


def q4(src: TableSource) -> DataFrame:
    """Q4: revenue by product and season over all years, seasons in calendar order."""
    t = src.dim("time_dim").select("date_id", calendar.season(F.month("date")).alias("season"))
    by_id = (_sales(src, "date_id", "product_id", "total_sale").join(t, "date_id")
             .groupBy("product_id", "season")
             .agg(arithmetic.money_sum("total_sale").alias("total_seasonal_sales")))
    return (by_id.join(_names(src, "product", "product_id", "product_name"), "product_id")
            .select("product_name", "season", "total_seasonal_sales")
            .orderBy("product_name", calendar.season_rank("season")))


def q5(src: TableSource, previous: str = "window") -> DataFrame:
    """Q5: monthly revenue per store and supplier beside the previous month.

    The previous month is the same store, supplier and year with month - 1
    (so January has none).  ``previous="self_join"`` is the left self-join
    on ``month = month + 1`` (J12).  The default ``"window"`` gives the same
    rows: the months of a (store, supplier, year) are unique after the
    aggregate, so ``lag`` plus an adjacency test finds the same partner with
    one shuffle of the monthly rows instead of two.
    """
    t = src.dim("time_dim").select("date_id", "year", F.month("date").alias("month"))
    monthly = (_sales(src, "date_id", "store_id", "supplier_id", "total_sale").join(t, "date_id")
               .groupBy("store_id", "supplier_id", "year", "month")
               .agg(arithmetic.money_sum("total_sale").alias("current_revenue")))
    if previous == "self_join":
        earlier = monthly.select("store_id", "supplier_id", "year", (F.col("month") + 1).alias("month"),
                                 F.col("current_revenue").alias("previous_revenue"))
        with_prev = monthly.join(earlier, ["store_id", "supplier_id", "year", "month"], "left")
    else:
        w = Window.partitionBy("store_id", "supplier_id", "year").orderBy("month")
        prev = F.when(F.lag("month").over(w) == F.col("month") - 1, F.lag("current_revenue").over(w))
        with_prev = monthly.withColumn("previous_revenue", prev.cast(MONEY_SUM))
    return (with_prev
            .join(_names(src, "store", "store_id", "store_name"), "store_id")
            .join(_names(src, "supplier", "supplier_id", "supplier_name"), "supplier_id")
            .select("store_name", "supplier_name",
                    F.col("month").cast("int").alias("current_month"),
                    "current_revenue", "previous_revenue",
                    arithmetic.change_pct("current_revenue", "previous_revenue").alias("revenue_volatility"))
            .orderBy("store_name", "supplier_name", "current_month"))


def product_pairs(baskets: DataFrame, basket: str = "transaction_id", item: str = "product_id") -> DataFrame:
    """``(product1_id, product2_id, frequency)``: item pairs within one basket.

    An equi-join on the basket key with ``a < b``.  On the fact the basket key
    is the primary key (checked by ``check_primary_keys``), so each basket
    holds one row and the join is one-to-one: it emits no pairs.
    """
    a = baskets.select(F.col(basket).alias("_b"), F.col(item).alias("product1_id"))
    b = baskets.select(F.col(basket).alias("_b"), F.col(item).alias("product2_id"))
    return (a.join(b, "_b").where(F.col("product1_id") < F.col("product2_id"))
            .groupBy("product1_id", "product2_id").agg(F.count(F.lit(1)).alias("frequency")))


def q6(src: TableSource, k: int = 5) -> DataFrame:
    """Q6: the ``k`` most frequent product pairs of one transaction (fact grain).

    The pairs are ranked by ids first and only the ``k`` winners meet the
    product names.  A foreign key ties every fact product to its dimension
    row, so the names drop no pair.
    """
    pairs = product_pairs(_sales(src, "transaction_id", "product_id"))
    top = pairs.orderBy(F.col("frequency").desc(), "product1_id", "product2_id").limit(k)
    return named_pairs(top, src.table("product"))


def q6_lines(lines: DataFrame, products: DataFrame, k: int = 5) -> DataFrame:
    """Q6 at line grain: the ``k`` product pairs that orders hold together most often.

    ``products`` holds one row per product id, as a dimension or a prepared master does.
    """
    return named_pairs(basket_pairs.top_pairs(lines.select("order_id", "product_id"), k), products)


def named_pairs(top: DataFrame, products: DataFrame) -> DataFrame:
    """The few ``top`` pairs with the names of their products, best first."""
    names = products.select("product_id", "product_name")
    p1 = names.toDF("product1_id", "product1_name")
    p2 = names.toDF("product2_id", "product2_name")
    top = F.broadcast(top)  # as many rows as were asked for
    named = p2.join(p1.join(top, "product1_id"), "product2_id")
    return (named.orderBy(F.col("frequency").desc(), "product1_id", "product2_id")
            .select("product1_name", "product2_name", "frequency"))


def q7(src: TableSource) -> DataFrame:
    """Q7: yearly revenue rolled up over store, supplier, product and year.

    ``grouping_id`` tells a subtotal row (bits set for the rolled-up columns)
    from a group whose key is a real NULL.  The finest level is aggregated once
    and the rollup adds up its rows, so the fact itself is not expanded.
    """
    t = src.dim("time_dim").select("date_id", "year")
    keys = ["store_name", "supplier_name", "product_name", "year"]
    finest = _named_sales(src, "date_id", "total_sale").join(t, "date_id").groupBy(*keys).agg(
        F.sum("total_sale").alias("rev"))
    return (finest.rollup(*keys)
            .agg(arithmetic.money_sum("rev").alias("yearly_revenue"),
                 F.grouping_id().cast("int").alias("grouping_id"))
            .orderBy(*keys))


def q8(src: TableSource, totals: str = "window") -> DataFrame:
    """Q8: revenue and quantity per product and half-year beside the product's
    total over all years.

    ``totals="join"`` aggregates the fact a second time per product and joins
    the two aggregates (J13).  The default ``"window"`` sums the at most two
    half-year rows of a product instead: same values, one scan of the fact.
    """
    t = src.dim("time_dim").select("date_id", calendar.half_year(F.month("date")).alias("half"))
    halves = (_sales(src, "date_id", "product_id", "total_sale", "quantity").join(t, "date_id")
              .groupBy("product_id", "half")
              .agg(arithmetic.money_sum("total_sale").alias("revenue_per_half"),
                   F.sum("quantity").cast("long").alias("quantity_per_half")))
    if totals == "join":
        yearly = (_sales(src, "date_id", "product_id", "total_sale", "quantity")
                  .join(src.dim("time_dim").select("date_id"), "date_id")
                  .groupBy("product_id")
                  .agg(arithmetic.money_sum("total_sale").alias("yearly_revenue"),
                       F.sum("quantity").cast("long").alias("yearly_quantity")))
        totals = halves.join(yearly, "product_id")
    else:
        w = Window.partitionBy("product_id")
        totals = halves.select(
            "product_id", "half", "revenue_per_half", "quantity_per_half",
            F.sum("revenue_per_half").over(w).cast(MONEY_SUM).alias("yearly_revenue"),
            F.sum("quantity_per_half").over(w).cast("long").alias("yearly_quantity"))
    return (totals.join(_names(src, "product", "product_id", "product_name"), "product_id")
            .select("product_name", "half", "revenue_per_half", "quantity_per_half",
                    "yearly_revenue", "yearly_quantity")
            .orderBy("product_name", "half"))


def q9(src: TableSource, mean: str = "window") -> DataFrame:
    """Q9: product-days whose revenue is above twice the product's mean day.

    Days without sales do not count in the mean.  The mean shown is the decimal
    average (six decimals, half up); the test is exact and strict: revenue times
    days is more than twice the product's total.
    ``mean="join"`` averages the daily aggregate per product and joins it
    back (J13); the default ``"window"`` averages over the product's days
    (bounded by the calendar) without the join.
    """
    t = src.dim("time_dim").select("date_id", "date")
    daily = (_sales(src, "date_id", "product_id", "total_sale").join(t, "date_id")
             .groupBy("product_id", "date").agg(F.sum("total_sale").alias("daily_revenue")))
    if mean == "join":
        totals = daily.groupBy("product_id").agg(
            F.avg("daily_revenue").alias("daily_average_revenue"), F.sum("daily_revenue").alias("_total"),
            F.count("daily_revenue").alias("_days"))
        with_mean = daily.join(totals, "product_id")
    else:
        w = Window.partitionBy("product_id")
        with_mean = daily.withColumns({
            "daily_average_revenue": F.avg("daily_revenue").over(w), "_total": F.sum("daily_revenue").over(w),
            "_days": F.count("daily_revenue").over(w)})
    above = F.col("daily_revenue") * F.col("_days").cast("decimal(10,0)") > 2 * F.col("_total")
    flagged = (with_mean
               .withColumn("spike_flag", F.when(above, F.lit("Outlier")).otherwise(F.lit("Normal")))
               .where(F.col("spike_flag") == "Outlier"))
    return (flagged.join(_names(src, "product", "product_id", "product_name"), "product_id")
            .select("product_name", "date",
                    F.col("daily_revenue").cast(MONEY_SUM).alias("daily_revenue"),
                    F.col("daily_average_revenue").cast(RATIO).alias("daily_average_revenue"),
                    "spike_flag")
            .orderBy("product_name", "date"))


VIEW_NAME = "store_quarterly_sales"


def store_quarterly_sales(src: TableSource) -> DataFrame:
    t = src.dim("time_dim").select("date_id", "year", F.quarter("date").alias("quarter"))
    by_id = (_sales(src, "date_id", "store_id", "total_sale").join(t, "date_id")
             .groupBy("store_id", "year", "quarter").agg(F.sum("total_sale").alias("rev")))
    return (by_id.join(_names(src, "store", "store_id", "store_name"), "store_id")
            .groupBy("store_name", "year", "quarter")
            .agg(arithmetic.money_sum("rev").alias("total_quarterly_sales"))
            .select("store_name", F.col("year").cast("int").alias("year"),
                    F.col("quarter").cast("int").alias("quarter"), "total_quarterly_sales")
            .orderBy("store_name", "year", "quarter"))


def q10(src: TableSource, spark=None) -> DataFrame:
    """Q10: store revenue by year and quarter, published as a temporary view."""
    df = store_quarterly_sales(src)
    df.createOrReplaceTempView(VIEW_NAME)
    return (spark or df.sparkSession).table(VIEW_NAME)
