"""Dense keys across loads, foreign keys by bitmaps, the fact clustered by several columns."""

from __future__ import annotations

import functools
import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.operators import clustering, key_bitmaps, quality
from starling.operators.surrogate import KeyMap, dense_numbers
from starling.plans import build as P
from starling.streaming.state_session import PROVIDER, ROCKSDB, rocksdb_session
from tests.conftest import SMOKE_DIR, plan_text


def key_map(spark, root):
    return KeyMap(spark, root, "v", T.StringType(), "k")


def values(spark, items):
    return spark.createDataFrame([(x,) for x in items], "v string")


# ------------------------------------------------------------------ dense keys
@pytest.mark.parametrize("parts", [1, 7])
def test_numbers_are_the_ranks_whatever_the_partitions(spark, parts):
    items = [f"v{i % 400:03d}" for i in range(2000)] + [None] * 5
    random.Random(1).shuffle(items)
    got = {r.v: r.k for r in dense_numbers(values(spark, items).repartition(parts), "v", "k", 11).collect()}
    assert got == {f"v{i:03d}": 11 + i for i in range(400)}


def test_a_value_keeps_its_number_over_loads(spark, tmp_dir):
    root = tmp_dir + "/map"
    assert key_map(spark, root).table().count() == 0
    assert key_map(spark, root).load(values(spark, ["m", "c", None, "m"]), 0)
    first = {r.v: r.k for r in key_map(spark, root).table().collect()}
    assert first == {"c": 1, "m": 2}
    again = key_map(spark, root)
    assert again.load(values(spark, ["a", "m", "z", "a"]), 1)
    assert not again.load(values(spark, ["q"]), 1)             # a repeated load gives no number
    assert again.load(values(spark, ["m"]), 2)                 # nothing new
    with pytest.raises(ValueError):
        again.load(values(spark, ["b"]), -1)
    assert {r.v: r.k for r in key_map(spark, root).table().collect()} == {**first, "a": 3, "z": 4}
    rows = {r.v: r.k for r in again.numbered(values(spark, ["z", "c", "unknown", None])).collect()}
    assert rows == {"z": 4, "c": 1, "unknown": None, None: None}


def test_a_load_that_died_gives_no_number(spark, tmp_dir):
    numbers = key_map(spark, tmp_dir + "/map")
    numbers.load(values(spark, ["b"]), 0)
    numbers.log.write(dense_numbers(values(spark, ["lost"]), "v", "k", 2), 1)   # no commit
    assert [r.v for r in numbers.table().collect()] == ["b"]
    numbers.load(values(spark, ["a"]), 1)
    assert {r.v: r.k for r in numbers.table().collect()} == {"b": 1, "a": 2}


# ------------------------------------------------------------------ bitmaps
def reports(spark, fact_keys, dim_keys):
    fact = spark.createDataFrame([(k,) for k in fact_keys], "f long")
    dims = {"d": spark.createDataFrame([(k,) for k in dim_keys], "p long")}
    return [check(fact, dims, {"f": "d"}, {"d": "p"}).collect()
            for check in (key_bitmaps.check_foreign_keys, quality.check_foreign_keys)]


@pytest.mark.parametrize("fact,dim", [
    ([1, 1, 2, None], [1, 2, 3]),
    ([0, -1, -32768, -32769, 32768, 32769, 1 << 40], [0, 32768]),
    ([5, 5, None], []), ([], [1]), ([], []), ([None], [1]),
])
def test_bitmaps_report_what_the_exact_check_does(spark, fact, dim):
    by_bitmap, exact = reports(spark, fact, dim)
    assert by_bitmap == exact


def test_random_keys_with_a_hot_one(spark):
    rng = random.Random(5)
    fact = [7] * 500 + [rng.randrange(-70_000, 140_000) for _ in range(1500)]
    by_bitmap, exact = reports(spark, fact, [k for k in set(fact) if k % 5])
    assert by_bitmap == exact and by_bitmap[0].orphan_rows > 0


def shuffled_rows(df):
    """Rows written by the shuffles of a query (no adaptive change)."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_dense_keys_are_not_shuffled_one_by_one(spark):
    fact = spark.range(0, 200_000, 1, 4).select((F.col("id") % 20_000 + 1).alias("f"))
    dims = {"d": spark.range(1, 20_001, 1, 2).select(F.col("id").alias("p"))}
    # as for a dimension too large to broadcast
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        by_bitmap = shuffled_rows(key_bitmaps.ranges_with_orphans(fact, "f", dims["d"], "p"))
        exact = shuffled_rows(quality.check_foreign_keys(fact, dims, {"f": "d"}, {"d": "p"}))
        clean = key_bitmaps.check_foreign_keys(fact, dims, {"f": "d"}, {"d": "p"})
        assert [r.orphan_rows for r in clean.collect()] == [0] and shuffled_rows(clean) == 0
    finally:
        for name in conf:
            spark.conf.unset(name)
    assert by_bitmap < 100 < 50_000 < exact


# ------------------------------------------------------------------ clustering
def test_interleaved_bits(spark):
    row = spark.createDataFrame([(0b101, 0b011)], "a long, b long")
    assert row.select(clustering.interleaved([F.col("a"), F.col("b")], 3)).first()[0] == 0b011011
    with pytest.raises(ValueError):
        clustering.interleaved([F.col("a")] * 4, 16)


@functools.cache
def file_ranges(path, column):
    """Least and greatest value of a column in every file with rows, from its statistics."""
    found = []
    for name in glob.glob(f"{path}/part-*.parquet"):
        meta = pq.ParquetFile(name).metadata
        if meta.num_rows:
            at = meta.schema.to_arrow_schema().names.index(column)
            stats = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
            found.append((min(s.min for s in stats), max(s.max for s in stats)))
    return found


def files_read(path, column, value):
    """Files whose statistics admit ``column = value``, of all files with rows."""
    ranges = file_ranges(path, column)
    return sum(lo <= value <= hi for lo, hi in ranges), len(ranges)


def test_a_store_a_product_and_a_date_each_skip_files(spark, tmp_dir):
    fact = P.warehouse(spark, SMOKE_DIR.replace("0.001", "0.01")).table("sales")
    by_all, by_date = tmp_dir + "/z", tmp_dir + "/date"
    clustering.cluster(fact, ["date_id", "store_id", "product_id"], "transaction_id", files=64).write.parquet(by_all)
    fact.repartitionByRange(64, "date_id", "transaction_id").sortWithinPartitions("date_id").write.parquet(by_date)
    assert spark.read.parquet(by_all).exceptAll(fact).count() == 0 and spark.read.parquet(by_all).count() == fact.count()
    share = {}
    for column in ("date_id", "store_id", "product_id"):
        wanted = [r[0] for r in fact.select(column).distinct().orderBy(column).collect()][::5]
        for name, path in (("all", by_all), ("date", by_date)):
            reads = [files_read(path, column, v) for v in wanted]
            assert min(hit for hit, _ in reads) >= 1
            share[column, name] = sum(hit / total for hit, total in reads) / len(reads)
    # 64 files are four steps a column: a quarter where the sampled cuts fall on the steps, twice that where a file
    # holds two of them, which happens most to the column with the lowest bits (the first)
    assert all(0.25 <= share[c, "all"] < 0.5 for c in ("date_id", "store_id", "product_id")), share
    assert share["store_id", "date"] > 0.9 and share["product_id", "date"] > 0.9, share  # by date alone
    assert "PushedFilters: [IsNotNull(store_id), EqualTo(store_id,3)]" in plan_text(
        spark.read.parquet(by_all).where("store_id = 3"))


def test_nulls_one_value_and_an_empty_table(spark):
    rows = spark.createDataFrame([(1, None, 5), (2, 3, 5), (3, None, 5)], "t long, a long, b long")
    assert sorted(clustering.cluster(rows, ["a", "b"], "t", files=2).collect(), key=lambda r: r.t) == rows.collect()
    assert clustering.cluster(rows.where("t < 0"), ["a", "b"], "t").count() == 0
    hot = spark.range(3000).select("id", F.lit(7).alias("a"))          # one position: the tie splits it
    sizes = [n for n in clustering.cluster(hot, ["a"], "id", files=3).rdd.glom().map(len).collect()]
    assert max(sizes) < 2000


# ------------------------------------------------------------------ state session
def test_the_state_session_leaves_the_callers_settings(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        before = spark.conf.get(PROVIDER, None)
        beside = rocksdb_session(spark)
        assert beside.conf.get(PROVIDER) == ROCKSDB and beside.conf.get("spark.sql.shuffle.partitions") == "5"
        assert spark.conf.get(PROVIDER, None) == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
