"""Quality rules: repetition and distribution divergence (DataFrame functions only).

Base rules per document: words, code points in words, symbols, repeated lines
and words in repeated 5-word windows.  Divergence: the histogram of the
document's character classes, and the histogram of its common words, are
compared with the reference of the document's language by Jensen-Shannon
distance (base 2, between 0 and 1).  A document shorter than a minimum length
gives no reliable histogram and is not judged by it (:class:`Limits`).  Either
distance rejects alone when it exceeds its limit by more than the noise of the
length; together they reject at a lower character distance.

References are measured over all documents of the language that look like prose
(:func:`references`), weighted by their length: sums per language,
pre-aggregated on the map side, one row per language (at most
``MAX_LANGUAGES``, enforced, so the table may be broadcast).  The common words are a fixed list of the most frequent
words of English, German, French and Spanish, and one cell for all other
words; the lists are parameters.

Everything about one document is computed inside its row: the 5-word windows
are hashed (XXH64 of the five words), and only a document with a repeated hash
sorts its windows.  No row is exploded, nothing is shuffled but the sums.

Defined cases: a null or empty text has no words and fails the base rules; a
null language is a language of its own; a language without prose
has no reference, and its documents are judged by the base rules alone; an
empty table gives an empty result; repeated rows are judged alike; other
columns are carried, whatever their names.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from starling.llm.common import WORD, small_table, text_or_empty, written

MAX_LANGUAGES = 1_000
WINDOW = 5

# The most frequent words of four languages.
COMMON_WORDS = {
    "en": "the of and to a in is that it for was on with as be".split(),
    "de": "der die und in den von zu das mit sich für des im auf ist".split(),
    "fr": "de la le et les en des un du une que est pour qui dans".split(),
    "es": "de la que el en y los se del un las por con no una".split(),
}
# Character classes, each a set of a regular expression; letters not in A-Z are
# counted by their bytes, and small letters are what is left.
CLASSES = {
    "upper": "[A-Z]",
    "digit": "[0-9]",
    "point": r"[.,;:!?'\"()\-]",
    "symbol": r"[#*$%&|<>]",
    "other": r"[@^~`+=_{}\[\]\\/]",
}


@dataclass(frozen=True)
class Limits:
    """Thresholds of the verdict."""

    min_words: int = 10            # fewer words: rejected
    max_repeat_percent: int = 20   # more words in repeated 5-word windows: rejected
    min_chars_judged: int = 150    # fewer code points: character classes are not judged
    min_words_judged: int = 40     # fewer words: common words are not judged
    max_char_distance: float = 0.20
    char_noise: float = 2.0        # the distance of n characters may exceed the limit by char_noise / sqrt(n)
    max_word_distance: float = 0.28  # counts only together with max_char_distance
    lone_word_distance: float = 0.17  # the word distance alone: a text above it, plus the noise of its length, goes
    word_noise: float = 1.15       # the distance of n words may exceed that by word_noise / sqrt(n)
    max_reference_symbols: float = 0.03  # share of symbols above which a document is no reference


LIMITS = Limits()
VOCABULARY = list(dict.fromkeys(w for words in COMMON_WORDS.values() for w in words))
_Q = "__quality_"


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def _window_hashes(words: Column, n: Column) -> Column:
    """XXH64 of every window of WINDOW words."""
    return F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(0), n.cast("int") - WINDOW),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))


def features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the base measures and the two histograms in columns ``__quality_*``."""
    df = docs.withColumn(_Q + "text", text_or_empty(text_col))
    text = F.col(_Q + "text")
    df = df.withColumn(_Q + "words", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    words = F.col(_Q + "words")
    df = df.withColumn(_Q + "n_words", F.size(words).cast("long"))
    n = F.col(_Q + "n_words")
    df = df.withColumns({
        _Q + "word_chars": F.char_length(F.array_join(words, "")).cast("long"),
        _Q + "hashes": _window_hashes(words, n),
        _Q + "lines": F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)),
        _Q + "common": F.filter(F.transform(words, F.lower), lambda w: w.isin(*VOCABULARY)),
        _Q + "rest": F.regexp_replace(text, r"[a-z\x20\x09-\x0D]+", ""),  # all but small letters: short
    })
    common = F.col(_Q + "common")
    df = df.withColumns({
        **{_Q + "c_" + k: _count(F.col(_Q + "rest"), p) for k, p in CLASSES.items()},
        _Q + "n_common": F.size(common).cast("long"),
        _Q + "common": F.concat(F.lit(" "), F.array_join(common, "  "), F.lit(" ")),
    })
    hashes = F.col(_Q + "hashes")
    df = df.withColumn(_Q + "sorted", F.when(
        F.size(F.array_distinct(hashes)) < F.size(hashes),
        F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    s = F.col(_Q + "sorted")

    def same(j: Column, x: Column) -> Column:
        return F.coalesce(F.get(s, j).getField("h") == x.getField("h"), F.lit(False))

    df = df.withColumn(_Q + "starts", F.array_sort(F.transform(
        F.filter(s, lambda x, j: same(j - 1, x) | same(j + 1, x)), lambda x: x.getField("i"))))
    starts = F.col(_Q + "starts")
    covered = _sum(F.transform(starts, lambda p, j: F.least(
        F.lit(WINDOW), F.coalesce(F.get(starts, j + 1) - p, F.lit(WINDOW))).cast("long")))
    lines = F.col(_Q + "lines")
    df = df.withColumns({
        # not deterministic on purpose: a filter on the verdict must not be pushed below
        # the measures, where it would compute them again for every use
        _Q + "row": F.monotonically_increasing_id(),
        _Q + "n_symbols": F.col(_Q + "c_symbol"),
        _Q + "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        _Q + "n_repeat_words": F.coalesce(covered, F.lit(0).cast("long")),
        _Q + "chars": _char_histogram(text, F.col(_Q + "word_chars")),
        _Q + "common_counts": _word_histogram(F.col(_Q + "common"), n),
    })
    return df.drop(*[_Q + c for c in ("words", "hashes", "lines", "common", "n_common", "rest", "sorted", "starts", "text",
                                      *["c_" + k for k in CLASSES])])


def _char_histogram(text: Column, word_chars: Column) -> Column:
    """Counts of the classes among the characters of words; the last two are wide and small letters."""
    counted = [F.col(_Q + "c_" + k) for k in CLASSES]
    wide = (F.octet_length(text) - F.char_length(text)).cast("long")
    small = word_chars - wide
    for c in counted:
        small = small - c
    return F.array(*counted, F.least(wide, word_chars), F.greatest(small, F.lit(0).cast("long")))


def _word_histogram(common: Column, n: Column) -> Column:
    """Counts of the vocabulary, and of all other words, from the common words one after the other.

    Each word stands between spaces of its own, so removing one word shortens
    the text by its count times its width: plain string work in generated code.
    """
    cells = []
    for w in VOCABULARY:
        width = len(f" {w} ".encode())
        cells.append(((F.octet_length(common) - F.octet_length(F.replace(common, F.lit(f" {w} "), F.lit("")))) / width)
                     .cast("long"))
    return F.array(*cells, n - F.col(_Q + "n_common"))


def with_base(df: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    n = F.col(_Q + "n_words")
    return df.withColumn(_Q + "base_failed", (n < limits.min_words) | (
        100 * F.col(_Q + "n_repeat_words") > limits.max_repeat_percent * n))


def references(measured: DataFrame, lang_col: str = "lang", limits: Limits = LIMITS) -> DataFrame:
    """One row per language: summed histograms of its documents that look like prose.

    Those have the least number of words and few symbols; the repeated windows,
    the costliest measure, are not needed here and are pruned from this pass.
    """
    prose = (F.col(_Q + "n_words") >= limits.min_words) & (
        F.col(_Q + "n_symbols") <= limits.max_reference_symbols * F.col(_Q + "word_chars"))

    def total(column: str, i: int) -> Column:
        return F.sum(F.when(prose, F.get(_Q + column, i)).otherwise(F.lit(0)))

    n_chars, n_cells = len(CLASSES) + 2, len(VOCABULARY) + 1
    cells = [total("chars", i).alias(f"c{i}") for i in range(n_chars)] + [
        total("common_counts", i).alias(f"w{i}") for i in range(n_cells)]
    rows = small_table(measured.groupBy(F.col(lang_col).cast("string").alias("lang")).agg(*cells),
                       MAX_LANGUAGES, "languages")
    out = [{"lang": r["lang"], "chars": [r[f"c{i}"] for i in range(n_chars)],
            "words": [r[f"w{i}"] for i in range(n_cells)]} for r in rows]
    kind = "array<struct<lang: string, chars: array<bigint>, words: array<bigint>>>"
    table = measured.sparkSession.range(1).select(F.inline(F.from_json(F.lit(json.dumps(out)), kind)))
    return table.toDF(_Q + "lang", _Q + "ref_chars", _Q + "ref_words")


def _entropy(p: Column) -> Column:
    return F.aggregate(p, F.lit(0.0), lambda a, x: a - F.when(x > 0, x * F.log2(x)).otherwise(F.lit(0.0)))


def with_js_distance(df: DataFrame, name: str, counts: str, reference: str) -> DataFrame:
    """Adds the Jensen-Shannon distance (base 2) of two histogram columns; null when one is empty.

    By entropies: the divergence is H((p + q) / 2) - (H(p) + H(q)) / 2.  Sums
    and shares are columns of their own, so each is computed once a row.
    """
    def shares(x: Column, total: Column) -> Column:
        return F.transform(x, lambda v: v / total)

    tp, tq, p, q = (f"{name}_{k}" for k in ("tp", "tq", "p", "q"))
    df = df.withColumns({tp: _sum(F.col(counts)), tq: _sum(F.col(reference))})
    df = df.withColumns({p: F.when(F.col(tp) > 0, shares(F.col(counts), F.col(tp))),
                         q: F.when(F.col(tq) > 0, shares(F.col(reference), F.col(tq)))})
    mixed = F.zip_with(p, q, lambda a, b: (a + b) / 2)
    divergence = _entropy(mixed) - (_entropy(F.col(p)) + _entropy(F.col(q))) / 2
    return df.withColumn(name, F.sqrt(F.greatest(divergence, F.lit(0.0)))).drop(tp, tq, p, q)


def judged(measured: DataFrame, refs: DataFrame, lang_col: str = "lang", limits: Limits = LIMITS) -> DataFrame:
    """Adds ``__quality_base_failed``, the two distances and ``__quality_kept`` to :func:`features`."""
    side = F.broadcast(refs)  # one row a language, at most MAX_LANGUAGES
    df = with_base(measured, limits).join(
        side, F.col(f"`{lang_col}`").cast("string").eqNullSafe(F.col(_Q + "lang")), "left")
    df = with_js_distance(df, _Q + "char_distance", _Q + "chars", _Q + "ref_chars")
    df = with_js_distance(df, _Q + "word_distance", _Q + "common_counts", _Q + "ref_words")
    n = F.col(_Q + "n_words")
    chars, size = F.col(_Q + "char_distance"), F.col(_Q + "word_chars")
    common = F.col(_Q + "word_distance")
    strange_chars = (size >= limits.min_chars_judged) & (
        chars > limits.max_char_distance + limits.char_noise / F.sqrt(size.cast("double")))
    strange_words = (n >= limits.min_words_judged) & (
        (chars > limits.max_char_distance) & (common > limits.max_word_distance)
        | (common > limits.lone_word_distance + limits.word_noise / F.sqrt(n.cast("double"))))
    diverges = F.coalesce(strange_chars, F.lit(False)) | F.coalesce(strange_words, F.lit(False))
    return df.withColumn(_Q + "kept", ~F.col(_Q + "base_failed") & ~diverges)


def verdicts(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text",
             limits: Limits = LIMITS) -> DataFrame:
    """One narrow row per document: id, language, the measures, the distances and ``__quality_kept``.

    The measures are written once, so the texts are read once.
    """
    narrow = written(features(docs.select(F.col(id_col), F.col(lang_col), F.col(text_col)), text_col).drop(text_col),
                     "quality-measures")
    return judged(narrow, references(narrow, lang_col, limits), lang_col, limits)


def keep_rows(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", limits: Limits = LIMITS) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns."""
    refs = references(features(docs.select(F.col(lang_col), F.col(text_col)), text_col), lang_col, limits)
    return judged(features(docs, text_col), refs, lang_col, limits).where(
        F.col(_Q + "kept") & (F.col(_Q + "row") >= 0)).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def measure(name: str) -> Column:
    """A measure of :func:`judged` by its plain name."""
    return F.col(_Q + name)
