"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, functions as F

from starling.session import scratch_dir

# Fixed value: a word is a run of characters other than space and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read back.

    Cuts the lineage: a lost executor recomputes at most the stage that reads it.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{purpose}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else (``lower`` would change É too).

    A pure ASCII text takes the fast ``lower``; both forms agree there.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER))


def n_words(text: Column) -> Column:
    """Number of words of a text, as a long."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def arrow_map(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` for a function of one record batch, an iterator step at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from function(batch)
    return df.mapInArrow(run, schema)


def edges_to_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges`` (``src``, ``dst``, longs).

    Returns ``(node, component)`` for every node with an edge to another node;
    ``component`` is the least node reachable.  Alternating large-star and
    small-star steps: each round is a pre-aggregated minimum per node and a
    join, so no neighbourhood is gathered in one task, and a node with very
    many edges is split by the skew join.  Every round is written as a table;
    the driver sees only the number of edges and a checksum.
    """
    def with_least(pairs: DataFrame) -> DataFrame:
        """Every (u, v) with the least neighbour of u."""
        return pairs.join(pairs.groupBy("u").agg(F.min("v").alias("m")), "u")

    def saved(e: DataFrame) -> tuple[DataFrame, tuple]:
        """The distinct edges as a table, with their number and a checksum from the same job."""
        seen = Observation()
        out = written(e.distinct().observe(seen, F.count(F.lit(1)).alias("n"), F.sum(
            F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")), "edges")
        got = seen.get
        return out, (got["n"], got["s"])

    # a > b in every stored edge
    e, now = saved(edges.where("src != dst").select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b")))
    last = None
    for _ in range(max_rounds):
        if now == last or now[0] == 0:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        last = now
        # large star: the neighbours above u go to the least of u and its neighbours
        both = with_least(e.toDF("u", "v").union(e.select(F.col("b").alias("u"), F.col("a").alias("v"))))
        large = both.where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        # small star: u and its neighbours (now all below u) go to the least of them
        low = with_least(large)
        e, now = saved(low.where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            low.select(F.col("u").alias("a"), F.col("m").alias("b"))))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def small_table(df: DataFrame, max_rows: int, what: str) -> list:
    """The rows of a table that is small by its nature, with the bound enforced."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} {what}; raise the bound if that is meant")
    return rows


def bounded_broadcast(table: DataFrame, max_bytes: int = 16 << 20) -> DataFrame:
    """A written table as a join side: broadcast when its measured rows fit ``max_bytes``, else left to Spark.

    One distributed aggregate measures it; the join gives the same rows either way.
    """
    width = F.lit(32)
    for f in table.schema.fields:
        width = width + (F.size(f.name) * 32 if f.dataType.typeName() == "array" else F.lit(16)
                         if f.dataType.typeName() not in ("string", "binary") else F.octet_length(f.name) + 16)
    size = table.agg(F.sum(width.cast("long"))).first()[0] or 0
    return F.broadcast(table) if size <= max_bytes else table
