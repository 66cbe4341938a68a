"""Exact top-k item pairs against counting every pair."""

from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from starling.operators import pairs
from starling.sources import testdata
from tests.conftest import plan_text

SCHEMA = "order_id long, product_id long"


def plain(data, k):
    baskets: dict = {}
    for o, p in data:
        if o is not None and p is not None:
            baskets.setdefault(o, Counter())[p] += 1
    counts = Counter()
    for b in baskets.values():
        for x, y in combinations(sorted(b), 2):
            counts[x, y] += b[x] * b[y]
    return [(x, y, n) for (x, y), n in sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:k]]


def result(spark, data, k, **kw):
    return [tuple(r) for r in pairs.top_pairs(spark.createDataFrame(data, SCHEMA), k, **kw).collect()]


def skewed(seed, orders=300, items=120):
    """Popular items, repeats inside orders, nulls, orders of one item, and one order that holds everything."""
    rng = random.Random(seed)
    data = [(o, min(items - 1, int(rng.paretovariate(0.6)))) for o in range(orders) for _ in range(rng.randrange(1, 9))]
    data += [(7777, p) for p in range(items)] + [(None, 1), (1, None), (8888, 5), (8888, 5)]
    return data


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("kw", [{}, {"promising": 5, "block": 7}, {"promising": 1, "block": 1000}])
def test_against_every_pair(spark, seed, kw):
    data = skewed(seed)
    assert result(spark, data, 5, **kw) == plain(data, 5)


def test_ties_go_to_the_least_ids(spark):
    data = [(o, p) for o in range(6) for p in (o, o + 1, o + 2)]
    assert result(spark, data, 4) == plain(data, 4)


def test_few_pairs_and_none(spark):
    assert result(spark, [(1, 2), (1, 3), (2, 9)], 5) == [(2, 3, 1)]
    assert result(spark, [(1, 2), (2, 3)], 5) == [] and result(spark, [], 5) == []


def test_the_bounds_leave_pairs_out(spark):
    """Of a skewed feed a small part of all pairs is emitted; the bounds are never below the truth."""
    rng = random.Random(5)
    data = [(o, p) for o in range(2000) for p in rng.sample(range(1000), 8)] + [(o, p) for o in range(120) for p in (3, 4, 5)]
    items = pairs.basket_items(spark.createDataFrame(data, SCHEMA), "order_id", "product_id")
    every = pairs._joined(items, pairs.BLOCK).count()
    bound = pairs.bounds(items)
    least = plain(data, 5)[-1][2]
    few = pairs.surviving_pairs(items, bound, least)
    assert few.count() < every / 10
    of = {r.item: r.bound for r in bound.collect()}
    bucket = {r.item: r.bucket for r in bound.collect()}
    for x, y, n in plain(data, 10**9):
        assert n <= of[x][bucket[y]] and n <= of[y][bucket[x]]
    assert result(spark, data, 5) == plain(data, 5)


def test_uniform_baskets_emit_fewer_pairs_than_there_are(spark):
    lines = testdata.feed_lines(spark, "/root/testdata/sf0.01")
    items = pairs.basket_items(lines, "order_id", "product_id")
    every = pairs._joined(items, pairs.BLOCK).count()
    bound = pairs._saved(pairs.bounds(items), "test")
    others = F.filter("bound", lambda _, j: j != F.col("bucket"))
    least = pairs.threshold(items, bound.select("item", F.array_max(others).alias("promise")), 5)
    assert least > 1 and pairs.surviving_pairs(items, bound, least).count() < every


def test_a_hot_basket_is_cut_into_blocks(spark):
    """No join key holds more than a block of items on either side, whatever the size of the basket."""
    data = [(1, p) for p in range(3000)] + [(2, 1), (2, 2)]
    items = pairs.basket_items(spark.createDataFrame(data, SCHEMA), "order_id", "product_id")
    joined = pairs._joined(items, 100)
    assert joined.count() == 3000 * 2999 // 2 + 1
    assert joined.groupBy("basket", "i", "j").count().agg(F.max("count")).first()[0] < 200 * 200
    assert "CartesianProduct" not in plan_text(joined) and "NestedLoop" not in plan_text(joined)


def test_baskets_are_counted_once_and_written(spark, monkeypatch):
    """The counting, with the joins behind its lines, runs in a job of its own; the sizes come from what it wrote."""
    written, saved = [], pairs._saved
    monkeypatch.setattr(pairs, "_saved", lambda df, purpose: written.append((purpose, plan_text(df))) or saved(df, purpose))
    lines = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 5), (None, 1), (3, None)], SCHEMA)
    out = pairs.basket_items(lines, "order_id", "product_id")
    assert sorted(map(tuple, out.collect())) == [(1, 1, 2), (1, 2, 1)]
    assert [purpose for purpose, _ in written] == ["counted", "items"]
    assert "Scan ExistingRDD" not in written[1][1] and "Scan parquet" in written[1][1]
