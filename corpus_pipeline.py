"""The corpus pipeline: quality rules, exact dedup, SimHash near-dedup, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.

Defined cases: nulls, empty and very long texts, ties, repeated rows and empty
tables as the operators define them; columns of ``docs`` beyond those of
``documents`` are dropped at every stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starling.llm import exact_dedup, mixing, packing, quality, simhash
from starling.llm.common import written
from starling.llm.queries import documents, tokenizer_file

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_rows(docs.select(*COLUMNS))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id stays."""
    return exact_dedup.keep_rows(docs.select(*COLUMNS))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies, the row with the least id stays."""
    return simhash.keep_rows(docs.select(*COLUMNS), shingle=3, max_bits=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    docs = docs.select(*COLUMNS)
    return mixing.mixed_rows(docs, mixing.plan(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs.select(*COLUMNS), tokenizer_file())


STAGES = [
    ("quality rules", drop_low_quality),
    ("exact dedup", drop_exact_copies),
    ("simhash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


# SQL cannot express the stages (XXH64, the tokenizer); tests/llm compares them with brute force.
ORACLE_SQL = None
