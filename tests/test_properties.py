"""Property test: on random small feeds, the optimised staging (keep-last
before the order-level joins) equals the general path (enrich every line,
then keep-last) and a brute force of the semantics in pandas."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starling.operators import enrich as E

LINES = st.lists(st.tuples(st.integers(1, 6),      # order
                           st.integers(1, 3),      # line number (repeats allowed)
                           st.integers(1, 6),      # product (5, 6 unknown)
                           st.integers(1, 4),      # supplier (4 unknown)
                           st.integers(1, 9)),     # quantity
                 min_size=1, max_size=25)
CUSTOMERS = st.lists(st.tuples(st.integers(1, 4), st.sampled_from(["Ann", "Bob", "Cy"])), max_size=6)
PRODUCTS = st.lists(st.tuples(st.integers(1, 4), st.sampled_from(["Lamp", "Desk"]),
                              st.sampled_from(["1.50", "2.00", "9.99"])), min_size=1, max_size=6)


def brute_force(lines, headers, customers, products, suppliers, stores):
    first = lambda rows, key: {k: min(r for r in rows if r[0] == k) for k in {r[0] for r in rows}}
    cust, prod, supp, store = first(customers, 0), first(products, 0), first(suppliers, 0), first(stores, 0)
    head = {o: (d, c) for o, d, c in headers}
    out = {}
    for o, ln, p, s, q in sorted(lines, key=lambda r: (r[0], r[1], r[2], r[3], r[4])):
        if o not in head or p not in prod or s not in supp or supp[s][2] not in store:
            continue
        d, c = head[o]
        if c not in cust:
            continue
        out[o] = (p, s, q, (Decimal(prod[p][2]) * q).quantize(Decimal("0.01")), cust[c][1], prod[p][1])
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lines=LINES, customers=CUSTOMERS, products=PRODUCTS)
def test_staging_paths_agree(spark, lines, customers, products):
    headers = [(o, dt.datetime(2020, 1, o), 1 + o % 4) for o in range(1, 6)]        # order 6 has no header
    suppliers = [(1, "S1", 1), (2, "S2", 2), (3, "S3", 9), (1, "A1", 2)]              # 3 has no store; 1 twice
    stores = [(1, "North"), (2, "South")]
    L = spark.createDataFrame(lines, "order_id long, line_number int, product_id long, supplier_id long, quantity int")
    H = spark.createDataFrame(headers, "order_id long, order_date timestamp_ntz, customer_id long")
    C = spark.createDataFrame([(k, n, "X") for k, n in customers],
                              "customer_id long, customer_name string, gender string")
    P = spark.createDataFrame([(k, n, Decimal(pr)) for k, n, pr in products],
                              "product_id long, product_name string, product_price decimal(10,2)")
    S = spark.createDataFrame(suppliers, "supplier_id long, supplier_name string, store_id long")
    ST = spark.createDataFrame(stores, "store_id long, store_name string")

    fast = E.staging_from_parts(L, H, C, P, S, ST)
    general = E.latest_per_order(E.enrich(L.join(H, "order_id"), C, P, S, ST, keep_order_columns=True))
    assert sorted(fast.collect()) == sorted(general.collect())

    want = brute_force(lines, headers, [(k, n, "X") for k, n in customers],
                       [(k, n, pr) for k, n, pr in products], suppliers, stores)
    got = {r.order_id: (r.product_id, r.supplier_id, r.quantity_ordered, r.total_sale, r.customer_name,
                        r.product_name) for r in fast.collect()}
    assert got == want
