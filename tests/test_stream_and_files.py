"""Streaming and file round trips (FIXTURES: CSV quoting, split invariance, replay)."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starling.operators import enrich as E
from starling.plans import build as P
from starling.sources import enriched_csv, feed_csv, testdata
from starling.streaming import feed_stream
from tests.conftest import SMOKE_DIR, plan_text
from tests.conftest import staging_row as row


def test_enriched_csv_quoting_round_trip(spark, make_staging, tmp_dir):
    names = ["Acme, Inc.", 'a "q" b', "plain", ""]
    stg = make_staging([row(i, "2024-01-01 10:00:00", product_id=i, product_name=n, store_name="S, 1")
                        for i, n in enumerate(names)])
    path = enriched_csv.write_enriched_csv(stg, tmp_dir + "/out")
    lines = {r.line for r in enriched_csv.read_enriched_lines(spark, path).collect()}
    assert '0,2024-01-01 10:00:00,0,1,1,Ann,F,"Acme, Inc.",10.00,1,"S, 1",1,supplier 1,10.00' in lines
    assert any('"a ""q"" b"' in x for x in lines)
    assert enriched_csv.rejected_enriched_rows(spark, path).count() == 0
    back = sorted(enriched_csv.read_enriched_csv(spark, path).collect())
    assert [r.product_name for r in back] == ["Acme, Inc.", 'a "q" b', "plain", ""]
    assert back[0].total_sale == Decimal("10.00") and back[0].store_name == "S, 1"


def _stream_result(spark, sf_dir, files, root):
    text = testdata.feed_text(spark, sf_dir)
    feed_dir = feed_csv.write_feed_csv(text, root + f"/feed{files}", files)
    m = P.Masters(spark, sf_dir)
    log, _ = feed_stream.stream_enrich_to_log(spark, feed_dir, m.customers, m.products, m.suppliers,
                                              m.stores, files_per_trigger=1, root=root + f"/s{files}")
    return log


def test_stream_equals_batch_for_any_split(spark, tmp_dir):
    batch_lines = sorted(P.enriched_lines(spark, SMOKE_DIR).collect())
    batch_latest = sorted(P.warehouse(spark, SMOKE_DIR).table("staging").collect())
    for files in (1, 2, 5):
        log = _stream_result(spark, SMOKE_DIR, files, tmp_dir)
        batches = feed_stream.read_log(spark, log, feed_stream.LOG_SCHEMA).select("batch_id").distinct().count()
        assert batches == files
        assert sorted(feed_stream.enriched_from_log(spark, log).collect()) == batch_lines
        assert sorted(feed_stream.latest_from_log(spark, log).collect()) == batch_latest


def test_replayed_batch_does_not_duplicate(spark, tmp_dir):
    writer = feed_stream._batch_writer(tmp_dir + "/log")
    df = spark.range(5).withColumn("v", F.col("id") * 2)
    writer(df, 0)
    writer(df, 1)
    writer(df, 1)  # the same batch id again, as after a restart
    assert feed_stream.read_log(spark, tmp_dir + "/log", df.schema).count() == 10


def test_warehouse_from_stream_log_equals_batch(spark, tmp_dir):
    """The streamed log feeds the star schema: Q10 over it equals the batch Q10."""
    from starling.operators import olap
    from starling.operators.warehouse import Warehouse
    log = _stream_result(spark, SMOKE_DIR, 3, tmp_dir)
    wh = Warehouse.build(spark, feed_stream.latest_from_log(spark, log), root=tmp_dir + "/wh")
    batch = P.warehouse(spark, SMOKE_DIR)
    assert sorted(olap.q10(wh).collect()) == sorted(olap.q10(batch).collect())
    assert sorted(olap.q7(wh).collect(), key=repr) == sorted(olap.q7(batch).collect(), key=repr)


def test_arrival_order_for_a_five_column_feed(spark, tmp_dir):
    """A feed in the warehouse's own layout (no sequence column; supplier and
    store come with the product): the later file, then the later line, wins;
    an unmatched later line replaces nothing; bad rows go to the quarantine."""
    import os
    from starling.schema import CUSTOMER_MASTER, PRODUCT_MASTER
    feed = tmp_dir + "/feed5"
    os.makedirs(feed)
    files = {
        "a.csv": ["1,2024-01-01 10:00:00,10,1,1", "2,2024-01-01 10:00:00,10,1,2"],
        "b.csv": ["1,2024-01-02 10:00:00,11,2,1", "1,2024-01-02 11:00:00,99,1,1",
                  "3,2024-01-03 10:00:00,10,1,3", "3,2024-01-03 11:00:00,11,3,3", "4,bad,10,1,1"],
    }
    for i, (name, lines) in enumerate(files.items()):
        path = os.path.join(feed, name)
        with open(path, "w") as f:
            f.write("Order ID,Order Date,Product ID,Quantity,Customer ID\n" + "\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + i * 100, 1_700_000_000 + i * 100))
    customers = spark.createDataFrame([(1, "Ann", "F"), (2, "Bob", "M"), (3, "Cy", "M")], CUSTOMER_MASTER)
    products = spark.createDataFrame(
        [(10, "Lamp", Decimal("2.50"), 5, "Acme, Inc.", 1, "North"),
         (11, "Desk", Decimal("10.00"), 6, "Zed", 2, "South")], PRODUCT_MASTER)
    log, bad = feed_stream.stream_enrich_to_log(spark, feed, customers, products, files_per_trigger=1,
                                                root=tmp_dir + "/s5", quarantine=True)
    got = {r.order_id: (r.product_id, r.total_sale, r.store_name)
           for r in feed_stream.latest_from_log(spark, log).collect()}
    assert got == {1: (11, Decimal("20.00"), "South"), 2: (10, Decimal("2.50"), "North"),
                   3: (11, Decimal("30.00"), "South")}
    assert [r.reject_reason for r in feed_stream.read_log(spark, bad, feed_stream.QUARANTINE_SCHEMA).collect()] == ["bad order_date"]


HEADER = "Order ID,Order Date,Product ID,Quantity,Customer ID"


def _five_column_case(spark, root):
    """Orders of many lines in several files; names, ages and product ids all disagree about what is last."""
    import os
    import random
    from starling.schema import CUSTOMER_MASTER, PRODUCT_MASTER
    rng = random.Random(4)
    feed = root + "/feed"
    os.makedirs(feed)
    want, age = {}, 1_700_000_000
    for name in ("part-10.csv", "part-9.csv", "a.csv", "z.csv"):  # oldest first, not in name order
        rows = []
        for _ in range(1500):
            order, product = rng.randrange(300), rng.randrange(14)
            rows.append(f"{order},2024-01-01 10:00:00,{product},1,{order % 7}")
            if product < 12 and order % 7 < 6:  # products 12, 13 and customer 6 are unknown
                want[order] = product
        path = os.path.join(feed, name)
        with open(path, "w") as f:
            f.write("\n".join([HEADER, *rows]) + "\n")
        age += 100
        os.utime(path, (age, age))
    customers = spark.createDataFrame([(c, f"c{c}", "F") for c in range(6)], CUSTOMER_MASTER)
    products = spark.createDataFrame([(p, f"p{p}", Decimal("1.00"), p % 3, "s", p % 2, "st") for p in range(12)], PRODUCT_MASTER)
    return feed, customers, products, want


def _set(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return old


@pytest.mark.parametrize("broadcasts", [None, "-1"])
@pytest.mark.parametrize("split", [None, "4k"])
def test_arrival_order_is_one_rule(spark, tmp_dir, broadcasts, split):
    """The same winners in batch, log and keyed state, with broadcasts on and off, one or many splits a file."""
    feed, customers, products, want = _five_column_case(spark, tmp_dir)
    old = _set(spark, {"spark.sql.autoBroadcastJoinThreshold": broadcasts, "spark.sql.files.maxPartitionBytes": split,
                       "spark.sql.files.openCostInBytes": "1k"})
    try:
        good = feed_csv.clean_feed(feed_csv.read_feed_text(spark, feed))
        lines = E.enrich(good, customers, products, keep_order_columns=True)
        log, _ = feed_stream.stream_enrich_to_log(spark, feed, customers, products, files_per_trigger=1, root=tmp_dir + "/l")
        state = feed_stream.stream_latest_state_to_log(spark, feed, customers, products, files_per_trigger=2, root=tmp_dir + "/k")
        got = {"lines": E.latest_per_order(lines), "narrow": E.latest_lines(good, E.prepare(customers, products)),
               "log": feed_stream.latest_from_log(spark, log),
               "state": feed_stream.latest_from_state_log(spark, state, customers, products)}
        for name, df in got.items():
            assert {r.order_id: r.product_id for r in df.collect()} == want, name
    finally:
        _set(spark, old)


def test_a_feed_without_any_order_is_refused(spark):
    feed = spark.createDataFrame([(1, 2)], "order_id long, product_id long")
    with pytest.raises(ValueError, match="last line"):
        E.latest_per_order(feed)


def test_headers_are_told_by_their_text(spark, tmp_dir):
    """Files with, without and with repeated headers lose no transaction."""
    import os
    os.makedirs(tmp_dir + "/f")
    row = "{},2024-01-01 10:00:00,10,1,1"
    files = {"none.csv": [row.format(1), row.format(2)], "head.csv": [HEADER, row.format(3)],
             "twice.csv": [HEADER, row.format(4), HEADER, "x,2024-01-01 10:00:00,1,1,1"], "only.csv": [HEADER]}
    for name, lines in files.items():
        with open(f"{tmp_dir}/f/{name}", "w") as f:
            f.write("\n".join(lines) + "\n")
    text = feed_csv.read_feed_text(spark, tmp_dir + "/f")
    good, bad, heads = (f(text).count() for f in (feed_csv.clean_feed, feed_csv.quarantine, feed_csv.header_lines))
    assert (good, bad, heads) == (4, 1, 4) and good + bad + heads == sum(map(len, files.values()))


def test_an_empty_feed_gives_empty_logs(spark, tmp_dir):
    import os
    from starling.schema import CUSTOMER_MASTER, PRODUCT_MASTER
    os.makedirs(tmp_dir + "/none")
    masters = spark.createDataFrame([], CUSTOMER_MASTER), spark.createDataFrame([], PRODUCT_MASTER)
    log, bad = feed_stream.stream_enrich_to_log(spark, tmp_dir + "/none", *masters, root=tmp_dir + "/s", quarantine=True)
    assert feed_stream.enriched_from_log(spark, log).count() == 0
    assert feed_stream.latest_from_log(spark, log).count() == 0 and feed_stream.read_log(
        spark, bad, feed_stream.QUARANTINE_SCHEMA).count() == 0
    state = feed_stream.stream_latest_state_to_log(spark, tmp_dir + "/none", *masters, root=tmp_dir + "/t")
    assert feed_stream.latest_from_state_log(spark, state, *masters).count() == 0


def test_bucketed_masters_leave_the_catalog(spark, tmp_dir):
    before = {t.name for t in spark.catalog.listTables()}
    _stream_result(spark, SMOKE_DIR, 1, tmp_dir)
    assert {t.name for t in spark.catalog.listTables()} <= before


def test_a_failing_job_is_not_written_again_without_buckets(spark, tmp_dir):
    from starling.operators.warehouse import save_bucketed
    bad = spark.range(10).select("id", F.expr("CAST(raise_error('broken row') AS INT)").alias("v"))
    with pytest.raises(Exception, match="broken row"):
        save_bucketed(spark, bad, tmp_dir + "/t", "id", "starling_broken_job")
    spark.sql("DROP TABLE IF EXISTS starling_broken_job")


def test_enriched_file_bad_rows_are_reported(spark, tmp_dir):
    import os
    os.makedirs(tmp_dir + "/e")
    with open(tmp_dir + "/e/part.csv", "w") as f:
        f.write(",".join(["h"] * 14) + "\n"
                "1,2024-01-01 10:00:00,7,2,3,Ann,F,Lamp,\"$1,299.99\",1,North,5,Acme,abc\n"
                "2,2024-01-01,7,2,3,Ann,F,Lamp,1.00,1,North,5,Acme,2.00\n"
                "3,2024-01-01 10:00:00,7,x,3,Ann,F,Lamp,1.00,1,North,5,Acme,2.00\n"
                "4,2024-01-01 10:00:00,7,2,3,Ann,F,Lamp,1.00,1,North\n")
    good = enriched_csv.read_enriched_csv(spark, tmp_dir + "/e").collect()
    assert [(r.order_id, r.product_price, r.total_sale) for r in good] == [(1, Decimal("1299.99"), Decimal("0.00"))]
    bad = {r.order_id: r.reject_reason for r in enriched_csv.rejected_enriched_rows(spark, tmp_dir + "/e").collect()}
    assert bad == {"2": "bad order_date", "3": "bad quantity_ordered", "4": "short row"}


def test_five_column_feed_is_dealt_out_once(spark, sf_rows_dir):
    text = testdata.five_column_feed_text(spark, sf_rows_dir)
    plan = plan_text(text)
    assert "rangepartitioning" not in plan
    part = text.withColumn("p", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()).collect()
    assert len(part) == 4 and all(r.supplier_id is None and r.line_number is None for r in part)
    mine = sorted((r for r in part if r.order_id == "7"), key=lambda r: r.at)
    assert [r.product_id for r in mine] == ["2", "5", "4"] and len({r.p for r in mine}) == 1
    assert {r.order_date for r in mine} == {"2020-01-02 00:00:00"}


@pytest.fixture
def sf_rows_dir(spark, tmp_path):
    spark.createDataFrame([(7, 5, 1, 2, 3.0), (7, 2, 1, 1, 1.0), (7, 4, 1, 3, 2.0), (8, 2, 1, 1, 1.0), (9, 2, 1, 1, 1.0)],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double"
                          ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("select id as o_orderkey, id as o_custkey, timestamp_ntz'2020-01-02 00:00:00' as o_orderdate from range(7, 9)"
              ).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_a_micro_batch_is_typed_once_and_as_in_batch(spark, tmp_dir):
    """The filter on good rows stays above the typing; reasons and order are those of the batch read."""
    import os
    feed = tmp_dir + "/odd"
    os.makedirs(feed)
    with open(feed + "/a.csv", "w") as f:
        f.write("\n".join(["Order ID,Order Date,Product ID,Quantity Ordered,Customer ID,Supplier ID,Line Number",
                           "1,2024-01-01 10:00:00,10,1,1,5,2", "2,2024-01-01 10:00:00,10,1,1", "3,2024-01-01,10,1,1,5,1",
                           "4,2024-01-01 10:00:00,10,x,1,5,1", "5,2024-01-01 10:00:00,10,1,1,y,1",
                           "6,2024-01-01 10:00:00,10,1,1,,", "7,2024-01-01 10:00:00,10,1,1,5,z", "8,2024", ",,,,,,"]))
    scan = feed_csv._with_file(spark.read.schema(feed_csv.FEED_TEXT).options(**feed_csv.CSV_OPTIONS).csv(feed))
    typed = feed_stream.typed_batch(scan)
    batch = feed_csv.type_feed(feed_csv.read_feed_text(spark, feed), (feed_csv.ARRIVAL,))
    assert typed.columns == batch.columns and [f.dataType for f in typed.schema] == [f.dataType for f in batch.schema]
    assert sorted(map(repr, typed.collect())) == sorted(map(repr, batch.collect()))
    good = typed.where(F.col("reject_reason").isNull()).select(*feed_csv.FEED_COLUMNS, feed_csv.ARRIVAL)
    assert [r.order_id for r in good.sort("order_id").collect()] == [1, 2, 6]
    assert plan_text(good).count("try_cast(trim(product_id") == 1  # the filter used to type every column again


def test_feed_in_parts_is_dealt_out_as_numbers(spark, monkeypatch):
    """No sort and no shuffle of the feed's text; more files for more lines, still four micro-batches."""
    parts = testdata.feed_text(spark, SMOKE_DIR, 8)
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, testdata.feed_text(spark, SMOKE_DIR).collect()))
    spread = parts.select("order_id", F.spark_partition_id().alias("part")).distinct().groupBy("order_id").count()
    assert spread.where("count > 1").count() > 1000  # the lines of an order lie in several files
    plan = plan_text(parts)
    assert plan.index("date_format") > plan.index("REPARTITION_BY_NUM")  # details come from the scans up
    assert "RoundRobin" not in plan
    assert P.feed_parts(spark, SMOKE_DIR) == P.FEED_PARTS
    monkeypatch.setattr(P, "FEED_PART_BYTES", 4 << 10)
    n = P.feed_parts(spark, SMOKE_DIR)
    assert n > P.FEED_PARTS and n % P.FEED_PARTS == 0
