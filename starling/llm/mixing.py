"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the budget in proportion to its weight; a source
whose share is above ``max_epochs`` times its size is clamped there and the
excess goes to the others by weight, until none is above
(:func:`water_fill`).  A source whose target is 1.3 times its size is taken
once whole, and 0.3 of it once more: documents in seeded hash order until the
remaining words are taken, the last of them in part.  So the words taken from
a source are its target rounded down, and no document is taken more than
``max_epochs`` times.

At scale: one pass sums sizes per (source, hash bucket), pre-aggregated on
the map side; the plan is a written table with one row per source, any number of
them, broadcast while its measured size is small.  All rows outside a
source's boundary bucket are then decided from their own bucket; only the
boundary bucket (1/4096 of a source) is ordered.  A source that holds a third
of all rows is thus never gathered.

Defined cases: a null text has size 0 and is taken 0 words; a null source is
a source of its own, last in the weight order; a source without words has
target 0; equal hashes (repeated or null ids) are ordered by size and text, so
repeated rows give the same multiset of results on every run; an empty table
gives an empty result; other columns are carried or ignored, whatever their
names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from starling.llm.common import WORD, bounded_broadcast, n_words, text_or_empty, written
from starling.operators.surrogate import dense_numbers

ROUNDS_A_TABLE = 16
BUCKET_HEX = 3          # hash buckets per source: 16 ** 3
BUDGET, MAX_EPOCHS, WEIGHTS, SEED = 1.5, 2, (5, 2, 1), 17

_SIZE, _SRC, _KEY, _BKT = "__mix_size", "__mix_source", "__mix_key", "__mix_bucket"


def water_fill(sources: DataFrame, budget: float, max_epochs: float) -> DataFrame:
    """``sources`` (``size``, ``weight``) with ``target``: shares of ``budget`` by weight, none above
    ``max_epochs`` times its size.

    A round is one aggregate over the sources: what the clamped ones hold and the weight of the free ones.  It
    gives the level of the next round, which may clamp more, until none is above.  The driver sees two sums a round.
    """
    clamped, weight_before, rounds = F.lit(False), None, 0
    while True:
        sums = sources.agg(F.sum(F.when(clamped, F.col("size"))).alias("held"),
                           F.sum(F.when(~clamped, F.col("weight"))).alias("free")).first()
        left, weight = budget - max_epochs * (sums["held"] or 0), sums["free"] or 0
        if weight == 0 or weight == weight_before:
            share = F.lit(float(left)) * F.col("weight") / F.lit(float(weight or 1))
            return sources.withColumn("target", F.when(clamped, F.col("size") * F.lit(float(max_epochs))).otherwise(
                F.greatest(F.lit(0.0), share)))
        clamped = clamped | (F.lit(float(left)) * F.col("weight") / F.lit(float(weight)) > F.col("size") * max_epochs)
        weight_before, rounds = weight, rounds + 1
        if rounds % ROUNDS_A_TABLE == 0:  # keeps the condition short
            held = [c for c in sources.columns if c != "__mix_clamped"]
            sources = written(sources.select(*held, clamped.alias("__mix_clamped")), "mix-clamped")
            clamped = F.col("__mix_clamped")


def _keyed(docs: DataFrame, id_col: str, source_col: str, text_col: str, seed: int) -> DataFrame:
    key = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary"))
    return docs.select(
        *[F.col(f"`{c}`") for c in docs.columns], n_words(text_or_empty(text_col)).alias(_SIZE),
        F.col(source_col).cast("string").alias(_SRC), key.alias(_KEY)).withColumn(
        _BKT, F.substring(_KEY, 1, BUCKET_HEX))


def plan(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
         budget: float = BUDGET, max_epochs: int = MAX_EPOCHS, weights: tuple = WEIGHTS, seed: int = SEED) -> DataFrame:
    """One row per source: size, target, whole repetitions, words still needed,
    the hash bucket where they end and the words of the buckets before it.

    ``weights`` are dealt to the sources in code point order, null last, repeating.
    """
    cells = _keyed(docs.select(id_col, source_col, text_col), id_col, source_col, text_col, seed).groupBy(
        _SRC, _BKT).agg(F.sum(_SIZE).alias("n")).select(_SRC, _BKT, "n")
    cells = written(cells, "mix-cells")
    totals = written(cells.groupBy(_SRC).agg(F.sum("n").alias("size")), "mix-totals")
    seen = totals.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"), F.count(_SRC).alias("named")).first()
    # the place of a source in code point order; the null one comes behind the others
    place = dense_numbers(totals, _SRC, "at", 0).select(F.col(_SRC).alias("s"), "at")
    deal = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        (F.coalesce("at", F.lit(seen["named"])) % len(weights) + 1).cast("int"))
    dealt = written(totals.join(place, F.col(_SRC) == F.col("s"), "left").select(_SRC, "size", deal.alias("weight")), "mix-weights")
    filled = water_fill(dealt, budget * (seen["size"] or 0), max_epochs)
    # whole repetitions; a quotient that was rounded up does not count
    near = F.floor(F.col("target") / F.col("size"))
    whole = F.when(F.col("size") > 0, near - (near * F.col("size") > F.col("target")).cast("long")).otherwise(F.lit(0)).cast("long")
    base = written(filled.withColumn("whole", whole).select(
        F.col(_SRC).alias("s"), F.col("size").alias("__mix_total"), F.col("target").alias("__mix_target"),
        F.col("whole").alias("__mix_whole"), (F.col("target") - F.col("whole") * F.col("size")).cast("long").alias("__mix_need")),
        "mix-base")
    # the boundary bucket: at most 16 ** BUCKET_HEX rows a source, in bucket order
    order = Window.partitionBy(_SRC).orderBy(_BKT).rowsBetween(Window.unboundedPreceding, -1)
    upto = cells.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))
    edges = upto.join(bounded_broadcast(base), F.col(_SRC).eqNullSafe(F.col("s"))).where(
        (F.col("before") <= F.col("__mix_need")) & (F.col("before") + F.col("n") > F.col("__mix_need"))).select(
        F.col(_SRC).alias("e"), _BKT, "before")
    return written(base.join(edges, F.col("s").eqNullSafe(F.col("e")), "left").select(
        F.col("s").alias(_SRC), "__mix_total", "__mix_target", "__mix_whole", "__mix_need",
        F.coalesce(_BKT, F.lit("~")).alias("__mix_edge"),
        F.coalesce("before", F.lit(0).cast("long")).alias("__mix_before")), "mix-plan")


def taken(docs: DataFrame, mix: DataFrame, id_col: str = "doc_id", source_col: str = "source",
          text_col: str = "text", seed: int = SEED) -> DataFrame:
    """``docs`` with the words taken of every document by the plan ``mix``.

    Adds ``__mix_size``, ``__mix_total``, ``__mix_target``, ``__mix_whole``
    (whole repetitions) and ``__mix_extra`` (words of the fractional one).
    """
    keyed = _keyed(docs, id_col, source_col, text_col, seed)
    side = bounded_broadcast(mix.withColumnRenamed(_SRC, "__mix_plan_source"))  # one row a source
    rows = keyed.join(side, F.col(_SRC).eqNullSafe(F.col("__mix_plan_source"))).drop("__mix_plan_source")
    inside = rows.where(F.col(_BKT) != F.col("__mix_edge")).withColumn(
        "__mix_extra", F.when(F.col(_BKT) < F.col("__mix_edge"), F.col(_SIZE)).otherwise(F.lit(0).cast("long")))
    order = Window.partitionBy(_SRC).orderBy(_KEY, _SIZE, F.md5(text_or_empty(text_col).cast("binary"))).rowsBetween(
        Window.unboundedPreceding, -1)
    edge = rows.where(F.col(_BKT) == F.col("__mix_edge")).withColumn(
        "__mix_extra", F.greatest(F.lit(0).cast("long"), F.least(
            F.col(_SIZE),
            F.col("__mix_need") - F.col("__mix_before") - F.coalesce(F.sum(_SIZE).over(order), F.lit(0)))))
    return inside.unionByName(edge)


def first_words(text: Column, n: Column) -> Column:
    """The first ``n`` words of a text with the white space before and between them."""
    pieces = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), n.cast("int")), "")


def mixed_rows(docs: DataFrame, mix: DataFrame, id_col: str = "doc_id", source_col: str = "source",
               text_col: str = "text", n_chars_col: str | None = "n_chars", seed: int = SEED) -> DataFrame:
    """The mixed corpus: every document as often as it is taken, with the columns of ``docs``.

    A fractional repetition of a document is its first words; its ``n_chars`` follows.
    """
    rows = taken(docs, mix, id_col, source_col, text_col, seed)
    whole = F.array_repeat(F.lit(-1).cast("long"), F.col("__mix_whole").cast("int") + (
        (F.col("__mix_extra") == F.col(_SIZE)) & (F.col(_SIZE) > 0)).cast("int"))
    part = F.when((F.col("__mix_extra") > 0) & (F.col("__mix_extra") < F.col(_SIZE)),
                  F.array(F.col("__mix_extra"))).otherwise(F.array().cast("array<bigint>"))
    out = rows.withColumn("__mix_cut", F.explode(F.concat(whole, part)))
    cut = F.when(F.col("__mix_cut") >= 0, first_words(F.col(text_col), F.col("__mix_cut"))).otherwise(F.col(text_col))
    cols = []
    for c in docs.columns:
        if c == text_col:
            cols.append(cut.alias(c))
        elif c == n_chars_col:
            cols.append(F.when(F.col("__mix_cut") >= 0, F.char_length(cut).cast(docs.schema[c].dataType))
                        .otherwise(F.col(f"`{c}`")).alias(c))
        else:
            cols.append(F.col(f"`{c}`"))
    return out.select(*cols)
