"""Exact top-k item pairs of baskets, without counting all pairs (Q6 at line grain).

A basket that holds item ``a`` m times and ``b`` n times counts the pair m * n
times.  Counting every pair costs the square of the basket sizes; most of that is
spent on pairs that cannot be among the first k.  Two bounds leave them out:

* Items.  A pair is no more frequent than its rarer item:
  ``weight(a)`` adds up, over the baskets of ``a`` with another item, m times the
  greatest multiplicity there.
* Buckets.  Items are hashed into ``BUCKETS`` buckets, and ``bound(a, j)`` adds up
  m times the greatest multiplicity of bucket j in the basket: no pair of ``a`` with
  an item of bucket j is more frequent.

A threshold is raised round by round (:func:`threshold`): the pairs among the few
most promising items are counted exactly, and the k-th best of them is a
frequency that the answer must reach.  Then (:func:`surviving_pairs`) only items
whose weight reaches the threshold stay, and a pair is emitted only when each
item's bound for the other's bucket reaches it; pairs of one bucket always are.
Bounds are never below the truth, so the answer is exact, ties included.

At scale: bounds are partial aggregates (a hot item or basket is reduced in the
map tasks).  A basket of more than ``BLOCK`` items is cut into blocks of items, and
each pair of blocks is a join key of its own, so no task sees a whole hot basket
squared.  The driver sees k frequencies a round; only the promising items, at
most ``PROMISING``, are broadcast.

Defined cases: equal items form no pair; null items or baskets are left out; fewer
than k pairs give them all; an empty table gives an empty result; ties go to the
least ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starling.session import scratch_dir

BUCKETS, BLOCK, PROMISING = 64, 256, 4096


def _saved(df: DataFrame, purpose: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, f"pairs-{purpose}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def basket_items(lines: DataFrame, basket: str, item: str) -> DataFrame:
    """Written once: basket, item, m (its lines in the basket), of baskets with two items or more."""
    # written first: the joins behind the lines and the two passes over the counts are not held by one task
    counted = _saved(lines.select(F.col(basket).alias("basket"), F.col(item).alias("item")).dropna().groupBy(
        "basket", "item").agg(F.count(F.lit(1)).alias("m")), "counted")
    sizes = counted.groupBy("basket").agg(F.count(F.lit(1)).alias("items")).where("items > 1")
    return _saved(counted.join(sizes.select("basket"), "basket", "left_semi"), "items")


def _bucket(item: Column) -> Column:
    return F.pmod(F.xxhash64(item), F.lit(BUCKETS)).cast("int")


def weights(items: DataFrame) -> DataFrame:
    """item, weight: no pair of the item is more frequent."""
    most = items.groupBy("basket").agg(F.max("m").alias("most"))
    return items.join(most, "basket").groupBy("item").agg(F.sum(F.col("m") * F.col("most")).alias("weight"))


def bounds(items: DataFrame) -> DataFrame:
    """item, bucket, bound (an array: entry j for pairs with bucket j)."""
    at = _bucket(F.col("item"))
    names = [f"c{j}" for j in range(BUCKETS)]
    held = items.groupBy("basket").agg(*[F.max(F.when(at == j, F.col("m"))).alias(c) for j, c in enumerate(names)])
    sums = items.join(held, "basket").groupBy("item").agg(
        *[F.coalesce(F.sum(F.col("m") * F.col(c)), F.lit(0).cast("long")).alias(c) for c in names])
    return sums.select("item", _bucket(F.col("item")).alias("bucket"), F.array(*names).alias("bound"))


def _mask(threshold: int) -> Column:
    """The buckets whose bound reaches the threshold, as bits of a long."""
    flags = F.transform("bound", lambda b, j: F.when(b >= threshold, F.call_function(
        "shiftleft", F.lit(1).cast("long"), j.cast("int"))).otherwise(F.lit(0).cast("long")))
    return F.aggregate(flags, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))


def _has(mask: str, bucket: str) -> Column:
    return F.call_function("getbit", F.col(mask), F.col(bucket)) == 1


def _joined(items: DataFrame, block: int) -> DataFrame:
    """Every pair a < b of a basket once, with m * n as ``times``; other columns carry a suffix of their side.

    Baskets are cut into blocks of about ``block`` items; the pair of blocks is part of the join key.
    """
    sizes = items.groupBy("basket").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    cut = items.join(sizes, "basket").withColumn("block", F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rest = [c for c in items.columns if c != "basket"]
    a = cut.select("basket", F.col("block").alias("i"), every.alias("j"), *[F.col(c).alias(f"{c}_a") for c in rest])
    b = cut.select("basket", every.alias("i"), F.col("block").alias("j"), *[F.col(c).alias(f"{c}_b") for c in rest])
    return a.join(b, ["basket", "i", "j"]).where(F.col("item_a") < F.col("item_b")).withColumn(
        "times", F.col("m_a") * F.col("m_b"))


def _frequencies(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("item_a", "item_b").agg(F.sum("times").alias("frequency"))


def threshold(items: DataFrame, ranked: DataFrame, k: int, promising: int = PROMISING, block: int = BLOCK) -> int:
    """A frequency that the k-th best pair reaches: that of the k-th best among the ``promising`` items
    that come first in ``ranked`` (item, promise); 1 when they form fewer than k pairs."""
    few = F.broadcast(ranked.orderBy(F.desc("promise"), "item").limit(promising).select("item"))
    best = _frequencies(_joined(items.join(few, "item", "left_semi"), block)).orderBy(F.desc("frequency")).limit(k)
    found = [r.frequency for r in best.select("frequency").collect()]
    return min(found) if len(found) == k else 1


def surviving_pairs(items: DataFrame, bound: DataFrame, least: int, block: int = BLOCK) -> DataFrame:
    """The pairs of every basket whose bounds reach ``least``: item_a, item_b, times."""
    marked = bound.select("item", "bucket", _mask(least).alias("mask"))
    pairs = _joined(items.join(marked, "item"), block)
    return pairs.where((F.col("bucket_a") == F.col("bucket_b")) | (
        _has("mask_a", "bucket_b") & _has("mask_b", "bucket_a"))).select("item_a", "item_b", "times")


def top_pairs(lines: DataFrame, k: int, basket: str = "order_id", item: str = "product_id",
              promising: int = PROMISING, block: int = BLOCK) -> DataFrame:
    """``(product1_id, product2_id, frequency)``: the ``k`` most frequent pairs, ties to the least ids."""
    items = basket_items(lines, basket, item)
    weight = _saved(weights(items), "weights")
    # round 1: the heaviest items
    least = threshold(items, weight.withColumnRenamed("weight", "promise"), k, min(promising, BLOCK), block)
    heavy = _saved(items.join(weight.where(F.col("weight") >= least).select("item"), "item", "left_semi"), "heavy")
    bound = _saved(bounds(heavy), "bounds")
    # round 2: the items with the best bound outside their own bucket, which counts the item itself
    others = F.filter("bound", lambda _, j: j != F.col("bucket"))
    least = max(least, threshold(heavy, bound.select("item", F.array_max(others).alias("promise")), k, promising, block))
    found = _frequencies(surviving_pairs(heavy, bound, least, block)).where(F.col("frequency") >= least)
    return found.orderBy(F.desc("frequency"), "item_a", "item_b").limit(k).select(
        F.col("item_a").alias("product1_id"), F.col("item_b").alias("product2_id"), "frequency")
