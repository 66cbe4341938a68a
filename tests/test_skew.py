"""Hot keys: one order holds a third of all lines, one product a third, one
customer a third of the orders.  With broadcasts off and AQE's skew split
forced on, the enrichment and keep-last must still equal a brute force."""

from __future__ import annotations

from pyspark.sql import functions as F

from starling.operators import enrich as E
from starling.operators.warehouse import TableSet
from starling.operators import olap

N = 30_000


def _feed(spark):
    ids = spark.range(N)
    hot = F.col("id") % 3 == 0
    lines = ids.select(
        F.when(hot, F.lit(0)).otherwise(F.col("id") % 4000 + 1).cast("long").alias("order_id"),
        F.when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id") % 500).cast("long").alias("product_id"),
        (F.col("id") % 9 + 1).cast("int").alias("quantity"),
        (F.col("id") % 20).cast("long").alias("supplier_id"),
        (F.col("id") % 13).cast("int").alias("line_number"))
    headers = spark.range(0, 4001).select(
        F.col("id").alias("order_id"),
        F.expr("timestamp_ntz'1997-01-01 00:00:00' + make_interval(0, 0, 0, CAST(id % 700 AS INT))").alias("order_date"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 300).cast("long").alias("customer_id"))
    customers = spark.range(0, 300).select(F.col("id").alias("customer_id"),
                                           F.concat(F.lit("c"), F.col("id")).alias("customer_name"),
                                           F.lit("X").alias("gender"))
    products = spark.range(0, 490).select(F.col("id").alias("product_id"),  # 490..499 unknown
                                          F.concat(F.lit("p"), F.col("id") % 50).alias("product_name"),
                                          (F.col("id") % 97 + F.lit(0.25)).cast("decimal(10,2)").alias("product_price"))
    suppliers = spark.range(0, 20).select(F.col("id").alias("supplier_id"),
                                          F.concat(F.lit("s"), F.col("id")).alias("supplier_name"),
                                          (F.col("id") % 5).alias("store_id"))
    stores = spark.range(0, 5).select(F.col("id").alias("store_id"), F.concat(F.lit("st"), F.col("id")).alias("store_name"))
    return lines, headers, customers, products, suppliers, stores


def test_hot_keys_keep_last_equals_brute_force(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        lines, headers, customers, products, suppliers, stores = _feed(spark)
        got = E.staging_from_parts(lines, headers, customers, products, suppliers, stores)
        got_pd = got.toPandas().sort_values("order_id").reset_index(drop=True)
        feed = lines.join(headers, "order_id")
        general = E.latest_per_order(E.enrich(feed, customers, products, suppliers, stores,
                                              keep_order_columns=True))
        assert sorted(general.collect()) == sorted(got.collect())

        # brute force in pandas
        L, H = lines.toPandas(), headers.toPandas()
        P, S = products.toPandas(), suppliers.toPandas()
        m = L[L.product_id.isin(P.product_id) & L.supplier_id.isin(S.supplier_id)]
        m = m.sort_values(["order_id", "line_number", "product_id", "supplier_id", "quantity"])
        last = m.groupby("order_id").tail(1).merge(H, on="order_id").merge(P, on="product_id")
        last = last.sort_values("order_id").reset_index(drop=True)
        assert len(got_pd) == len(last)
        assert (got_pd.product_id.values == last.product_id.values).all()
        exp_total = (last.quantity.astype(int) * last.product_price.map(float)).round(2)
        assert (got_pd.total_sale.map(float).round(2).values == exp_total.values).all()
        hot = got_pd[got_pd.order_id == 0].iloc[0]
        assert hot.product_id == last[last.order_id == 0].iloc[0].product_id

        # queries over the skewed warehouse still agree with their join forms
        t = TableSet.from_staging(got)
        assert sorted(olap.q9(t).collect()) == sorted(olap.q9(t, mean="join").collect())
        assert sorted(olap.q5(t).collect()) == sorted(olap.q5(t, previous="self_join").collect())
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
