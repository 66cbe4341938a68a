"""Enrichment semantics (FIXTURES: last matched wins, unmatched does not
replace, unknown keys, master duplicates)."""

from __future__ import annotations

from decimal import Decimal

from starling.operators import enrich as E
from starling.schema import CUSTOMER_MASTER, FEED, PRODUCT_MASTER
from tests.conftest import plan_text, ts

CUSTOMERS = [(1, "Ann", "F"), (2, "Bob", "M")]
PRODUCTS = [(10, "Lamp", Decimal("12.50"), 5, "Acme, Inc.", 3, "North"),
            (11, "Desk", Decimal("99.99"), 5, "Acme, Inc.", 4, "South")]


def _feed(spark, rows):
    return spark.createDataFrame([(o, ts(d), p, q, c, None, n) for o, d, p, q, c, n in rows], FEED)


def _masters(spark, customers=CUSTOMERS, products=PRODUCTS):
    return (spark.createDataFrame(customers, CUSTOMER_MASTER),
            spark.createDataFrame(products, PRODUCT_MASTER))


def test_last_matched_line_wins(spark):
    c, p = _masters(spark)
    feed = _feed(spark, [(1, "2024-01-01 10:00:00", 10, 2, 1, 1),
                         (1, "2024-01-01 11:00:00", 11, 1, 1, 2)])
    out = E.latest_per_order(E.enrich(feed, c, p, keep_order_columns=True)).collect()
    assert len(out) == 1 and out[0].product_id == 11 and out[0].total_sale == Decimal("99.99")
    assert out[0].store_id == 4 and out[0].supplier_name == "Acme, Inc."


def test_unmatched_later_line_does_not_replace(spark):
    c, p = _masters(spark)
    feed = _feed(spark, [(1, "2024-01-01 10:00:00", 10, 2, 1, 1),
                         (1, "2024-01-01 11:00:00", 99, 1, 1, 2)])
    out = E.latest_per_order(E.enrich(feed, c, p, keep_order_columns=True)).collect()
    assert [(r.product_id, r.total_sale) for r in out] == [(10, Decimal("25.00"))]


def test_unknown_customer_and_product_are_reported(spark):
    c, p = _masters(spark)
    feed = _feed(spark, [(1, "2024-01-01 10:00:00", 10, 1, 9, 1),
                         (2, "2024-01-01 10:00:00", 77, 1, 1, 1),
                         (3, "2024-01-01 10:00:00", 10, 1, 2, 1)])
    assert [r.order_id for r in E.enrich(feed, c, p).collect()] == [3]
    report = {r.order_id: r.reason for r in E.unmatched(feed, c, p).collect()}
    assert report == {1: "unknown customer", 2: "unknown product"}


def test_master_duplicates_first_in_stated_order(spark):
    products = PRODUCTS + [(10, "Aardvark lamp", Decimal("1.00"), 6, "Zed", 3, "North")]
    c, p = _masters(spark, products=products)
    feed = _feed(spark, [(1, "2024-01-01 10:00:00", 10, 1, 1, 1)])
    out = E.enrich(feed, c, p).collect()
    assert len(out) == 1 and out[0].product_name == "Aardvark lamp"


def test_keep_last_with_hot_key_is_partial(spark):
    """A key holding most rows is reduced map-side: the plan aggregates partially."""
    from starling.operators.keep import keep_last
    df = spark.range(0, 20000).selectExpr("CAST(id % 3 = 0 AS INT) * 0 AS k", "id", "CAST(id AS STRING) AS s")
    assert "partial_max" in plan_text(keep_last(df, "k", ["id"]))
    assert keep_last(df, "k", ["id"]).first().id == 19999


def test_unmatched_supplier_and_store(spark):
    from starling.schema import FEED
    c, _ = _masters(spark)
    products = spark.createDataFrame([(10, "Lamp", Decimal("1.00"))],
                                     "product_id long, product_name string, product_price decimal(10,2)")
    suppliers = spark.createDataFrame([(5, "S5", 1), (6, "S6", 99), (6, "A6", 1)],
                                      "supplier_id long, supplier_name string, store_id long")
    stores = spark.createDataFrame([(1, "North")], "store_id long, store_name string")
    feed = spark.createDataFrame([(1, ts("2024-01-01 10:00:00"), 10, 1, 1, 5, 1),
                                  (2, ts("2024-01-01 10:00:00"), 10, 1, 1, 7, 1),
                                  (3, ts("2024-01-01 10:00:00"), 10, 1, 1, 6, 1)], FEED)
    # supplier 6: first match is "A6" with store 1, so order 3 is matched
    kept = {r.order_id: r.supplier_name for r in E.enrich(feed, c, products, suppliers, stores).collect()}
    assert kept == {1: "S5", 3: "A6"}
    report = {r.order_id: r.reason for r in E.unmatched(feed, c, products, suppliers, stores).collect()}
    assert report == {2: "unknown supplier"}
    stores_missing = spark.createDataFrame([(2, "South")], "store_id long, store_name string")
    report = {r.order_id: r.reason for r in E.unmatched(feed, c, products, suppliers, stores_missing).collect()}
    assert report == {1: "unknown store", 2: "unknown supplier", 3: "unknown store"}


def test_missing_price_sells_at_zero_and_oversized_totals_are_reported(spark):
    c, p = _masters(spark, products=PRODUCTS + [(12, "Gift", None, 5, "Acme, Inc.", 3, "North"),
                                                (13, "Yacht", Decimal("99999999.99"), 5, "Acme, Inc.", 3, "North")])
    feed = _feed(spark, [(1, "2024-01-01 10:00:00", 12, 3, 1, 1), (2, "2024-01-01 10:00:00", 13, 1, 1, 1),
                         (3, "2024-01-01 10:00:00", 10, 1, 1, 1), (3, "2024-01-01 10:00:00", 13, 2, 1, 2)])
    want = {1: (None, Decimal("0.00")), 2: (Decimal("99999999.99"), Decimal("99999999.99")),
            3: (Decimal("12.50"), Decimal("12.50"))}  # the oversized later line replaces nothing
    lines = E.enrich(feed, c, p, keep_order_columns=True)
    assert {r.order_id: (r.product_price, r.total_sale) for r in E.latest_per_order(lines).collect()} == want
    assert {r.order_id: (r.product_price, r.total_sale)
            for r in E.latest_lines(feed, E.prepare(c, p)).collect()} == want
    assert [(r.order_id, r.line_number, r.reason) for r in E.oversized(feed, c, p).collect()] == [
        (3, 2, "total out of range")]


def test_the_last_line_of_parts_is_picked_without_names(spark):
    """Every line is sorted by order to pick the last: ids and quantity only."""
    feed = _feed(spark, [(1, "2024-01-01 10:00:00", 10, 2, 1, 1), (1, "2024-01-01 10:00:00", 11, 1, 1, 2)])
    lines = feed.select("order_id", "product_id", "quantity", "line_number")
    headers = feed.select("order_id", "order_date", "customer_id").distinct()
    out = E.staging_from_parts(lines, headers, *_masters(spark))
    assert [(r.product_id, r.product_name, r.supplier_id, r.customer_name) for r in out.collect()] == [(11, "Desk", 5, "Ann")]
    picks = [x for x in plan_text(out).splitlines() if "max(struct(" in x]
    assert picks and not any("_name" in x for x in picks)


def test_lines_of_parts_are_not_shuffled_by_customer(spark):
    feed = _feed(spark, [(1, "2024-01-01 10:00:00", 10, 2, 1, 1), (1, "2024-01-01 10:00:00", 11, 1, 1, 2),
                         (2, "2024-01-01 10:00:00", 10, 1, 9, 1)])
    lines, headers = feed.drop("order_date", "customer_id"), feed.select("order_id", "order_date", "customer_id").distinct()
    c, p = _masters(spark)
    out = E.enrich_parts(lines, headers, E.prepare(c, p))
    assert sorted(out.collect()) == sorted(E.enrich(feed, c, p).collect()) and out.count() == 2
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_text(E.enrich_parts(lines, headers, E.prepare(c, p)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    details = text[text.index("\n(1) "):].split("\n\n")
    by_customer = [x for x in details if "Exchange" in x and "hashpartitioning(customer_id" in x]
    assert by_customer and not any("product_id" in x for x in by_customer)
