"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from starling.llm import collocations, exact_dedup, html_text, license_scan, line_dedup, mixing, packing, paragraph_dedup, quality, simhash, source_audit, token_count, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_file() -> str:
    """The tokenizer of the packing contract; another path may be given to the operator."""
    import public_tokenizers
    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_mix_sources(spark, sf_dir):
    """Every document with its size, its source's size and target, and the words the mix takes."""
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    rows = mixing.taken(docs, mixing.plan(docs))
    return rows.select(
        "doc_id", F.col("__mix_size").alias("size"), F.col("__mix_total").alias("source_size"),
        F.col("__mix_target").alias("target"),
        (F.col("__mix_whole") * F.col("__mix_size") + F.col("__mix_extra")).alias("taken"))


def op2_exact_dedup(spark, sf_dir):
    """Every document with the id that stays of its equal texts."""
    return exact_dedup.decisions(documents(spark, sf_dir))


def op3_quality_rules(spark, sf_dir):
    """Every document with its base measures and the verdict."""
    rows = quality.verdicts(documents(spark, sf_dir))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return rows.select("doc_id", *[quality.measure(n).alias(n) for n in names])


def op4_html_text(spark, sf_dir):
    """Every page with its main text."""
    return html_text.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op5_toxicity(spark, sf_dir):
    """Every document with its toxicity score; rows with crc32(doc_id) mod 3 = 1 are held out of training."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    remainder = F.crc32(F.col("id").cast("string").cast("binary")) % 3
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(*toxicity.training_rows(docs, labels, remainder != 1))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return toxicity.scores(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= toxicity.DECISION).cast("int").alias("predicted"))


def op6_paragraph_dedup(spark, sf_dir):
    """Every paragraph of a passage that repeats, with the paragraph of its class that stays."""
    return paragraph_dedup.passages(documents(spark, sf_dir))


def op7_pack_sequences(spark, sf_dir):
    """Every piece of every document with its place in the packed sequences."""
    return packing.pack(documents(spark, sf_dir), tokenizer_file())


def op8_token_counts(spark, sf_dir):
    """Every document with its number of greedy word pieces, words and unknown words."""
    return token_count.token_counts(documents(spark, sf_dir), tokenizer_file())


def op9_simhash_groups(spark, sf_dir):
    """Every document with its fingerprint and the least id of its group."""
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=3, max_bits=2)


def op10_line_dedup(spark, sf_dir):
    """Every document with its lines that an equal or nearly equal earlier line drops."""
    return line_dedup.row_decisions(documents(spark, sf_dir))


def op11_collocations(spark, sf_dir):
    """The first 2,000 collocations of every language."""
    return collocations.top_phrases(collocations.collocations(documents(spark, sf_dir)))


def op12_source_audit(spark, sf_dir):
    """Every source of a language against the others, and the terms it uses more than the language does."""
    return source_audit.audit(documents(spark, sf_dir))


def op13_license_scan(spark, sf_dir):
    """Every document with its licence phrases and the labels of the licence texts it holds."""
    return license_scan.labelled(license_scan.scan(documents(spark, sf_dir)))


QUERIES: dict[str, Query] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_html_text": op4_html_text,
    "op5_toxicity": op5_toxicity,
    "op6_paragraph_dedup": op6_paragraph_dedup,
    "op7_pack_sequences": op7_pack_sequences,
    "op8_token_counts": op8_token_counts,
    "op9_simhash_groups": op9_simhash_groups,
    "op10_line_dedup": op10_line_dedup,
    "op11_collocations": op11_collocations,
    "op12_source_audit": op12_source_audit,
    "op13_license_scan": op13_license_scan,
}
