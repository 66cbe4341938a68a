"""Source divergence audit by chunk factorization.

Which terms does a source use more, or less, than the other sources of its
language?  Texts are cut at white space into chunks (A-Z lower-cased), and most
of a corpus is a small number of distinct chunks.  So the chunks are counted per
document and added up, and each distinct chunk of a language is cut into terms once
(:func:`term_parts`, :func:`term_counts`).

Distinct documents.  Two chunks of one document may hold the same term (``tree``
and ``tree,``), so a term's documents lie between the largest count of one of
its chunks and the sum over its chunks.  The first pass over the documents
counts chunks per language only, and these bounds leave few terms: those below
the least number of documents are out.  The second pass counts the chunks of the
others per source, by 64-bit hashes; chunks whose hash another chunk has too (the
distinct chunks are known by then) are counted by their text.  A term between
its bounds has few documents a chunk; for these the second pass names the
documents too, and they are counted exactly.
Which terms and chunks to look for goes to the tasks as hash sets of fixed size;
exact counts and joins follow, so one too many is no harm.

At scale: a task adds up its blocks of documents before anything is shuffled.
The first pass is dealt out by chunk, where the distinct chunks are cut
without a second shuffle.  Only the hash sets, and chunk tables of
measured size, are broadcast.  Sources are compared in blocks of terms, each a
dense matrix of bounded size in one task (:func:`pair_differences`); a block
gives one partial sum a pair.

Shares are exact integers in parts per billion (:data:`UNIT`), smoothed by
:data:`SMOOTHING` occurrences a term; products are decimals of 38 digits.

Defined cases: a null text, language or source is empty; a group without terms
has the share of an unseen term everywhere; a language without kept terms gives
pairs of value 0; repeated rows are documents of their own; a text of any length
is read whole; ties are ranked by item in byte order; an empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from starling.llm.common import arrow_map, bounded_broadcast, text_or_empty, written
from starling.llm.text_bytes import blocks, byte_class, gather, gather_all, hash_set, held, spans, string_hashes, word_hashes

# Fixed value: a term is a run of letters A-Z, a-z and code points outside ASCII.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
CHUNK = byte_class(" \t\n\x0b\x0c\r", inverted=True)
TERM_BYTE = byte_class([*range(65, 91), *range(97, 123), *range(128, 256)])
MIN_DOCUMENTS, SMOOTHING, UNIT, TOP_TERMS = 30, 5, 1_000_000_000, 50
#: Bytes of text whose chunks the first pass adds up at a time: it holds less than the second.
COUNT_BLOCK = 8 << 20
#: Size of the set of hashes that two chunks share: there are hardly any.
SHARED_BITS = 16
#: Rows of sums that the second pass holds to add up over its blocks.
MERGE = 1 << 20
FOUND = ["lang", "source", "h", "chunk", "occ", "row"]
#: Cells of a dense block of terms by sources.
CELLS = 1 << 17


def _rows(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in (
        (lang_col, "lang"), (source_col, "source"))], text_or_empty(text_col).alias("text"))


def _chunks_of(data: np.ndarray, bounds: np.ndarray):
    """Distinct (row, chunk) of a block: row, code, and the chunks by code."""
    start, end, row = spans(data, bounds, CHUNK)
    coded = gather_all(data, start, end, CHUNK).dictionary_encode()
    code, chunks = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    key, _ = _sums(row * max(1, len(chunks)) + code)
    return key // max(1, len(chunks)), key % max(1, len(chunks)), chunks


def _hashes_of(data: np.ndarray, bounds: np.ndarray, wanted: np.ndarray, undecided: np.ndarray, shared: np.ndarray):
    """Distinct (row, chunk) of a block with their counts, of the chunks that hold a term and whose hash is in
    ``wanted``: row, code, count, and by code the hash, the text (empty unless the hash is in ``shared``) and
    whether the hash is in ``undecided``."""
    start, end, row = spans(data, bounds, CHUNK)
    h = word_hashes(data, start, end)
    letters = np.zeros(len(data) + 1, dtype=np.int32)
    np.cumsum(TERM_BYTE[data], out=letters[1:])
    use = np.flatnonzero(held(h, wanted) & (letters[end] > letters[start]))
    start, end, row, h = start[use], end[use], row[use], h[use]
    text = None
    twice = held(h, shared)
    if twice.any():
        # hashes do not tell these chunks apart: number (hash, text) instead
        texts = pa.array(np.full(len(h), "", dtype=object), pa.string())
        texts = pc.replace_with_mask(texts, pa.array(twice), gather(data, start[twice], end[twice]))
        names, both = pa.array(h.view(np.int64)).dictionary_encode(), texts.dictionary_encode()
        pair = names.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(both.dictionary) + both.indices.to_numpy(
            zero_copy_only=False)
        coded = pa.array(pair).dictionary_encode()
        of = coded.dictionary.to_numpy()
        hashes = names.dictionary.to_numpy()[of // len(both.dictionary)].view(np.uint64)
        text = both.dictionary.take(pa.array(of % len(both.dictionary)))
    else:
        coded = pa.array(h.view(np.int64)).dictionary_encode()
        hashes = coded.dictionary.to_numpy().view(np.uint64)
        text = pa.array([""], pa.string()).take(pa.array(np.zeros(len(hashes), dtype=np.int64)))
    code = coded.indices.to_numpy(zero_copy_only=False)
    n = max(1, len(hashes))
    key, count = _sums(row * n + code)
    return key // n, key % n, count, hashes, text, held(hashes, undecided)


class _Sums:
    """Sums of counts by (group, hash) over the blocks of a task; at most about ``MERGE`` rows are held."""

    def __init__(self):
        self.number, self.tables, self.rows = {}, [], 0

    def add(self, names: list[tuple[str, str]], group: np.ndarray, h: np.ndarray, occ: np.ndarray) -> None:
        of = np.array([self.number.setdefault(p, len(self.number)) for p in names], dtype=np.int64)
        self.tables.append(pa.table([pa.array(of[group]), pa.array(h.view(np.int64)), pa.array(occ)], names=["g", "h", "occ"]))
        self.rows += len(group)

    def full(self) -> bool:
        return self.rows >= MERGE

    def taken(self) -> Iterator[pa.RecordBatch]:
        """The sums so far (lang, source, h, chunk, occ, row); they start anew."""
        if self.rows:
            t = pa.concat_tables(self.tables).combine_chunks()
            if len(self.tables) > 1:
                t = t.group_by(["g", "h"], use_threads=False).aggregate([("occ", "sum")]).rename_columns(["g", "h", "occ"])
            names, n = list(self.number), t.num_rows
            g = t.column("g").combine_chunks()
            langs, sources = (pa.array([p[k] for p in names], pa.string()).take(g) for k in (0, 1))
            none = pa.array([""], pa.string()).take(pa.array(np.zeros(n, dtype=np.int64)))
            yield pa.RecordBatch.from_arrays([langs, sources, t.column("h").combine_chunks(), none,
                                              t.column("occ").combine_chunks(), pa.nulls(n, pa.int64())], names=FOUND)
        self.number, self.tables, self.rows = {}, [], 0


def _shared_hashes(parts: DataFrame) -> DataFrame:
    """h: the hashes that two different chunks of ``parts`` have (told apart by a second hash)."""
    def hashes(b):
        h = pa.array(string_hashes(b.column("chunk")).view(np.int64))
        yield pa.RecordBatch.from_arrays([h, b.column("other")], names=["h", "other"])

    both = arrow_map(parts.select("chunk", F.xxhash64("chunk").alias("other")), hashes, "h long, other long")
    return both.groupBy("h").agg(F.min("other").alias("a"), F.max("other").alias("b")).where("a != b").select("h")


def _sums(key: np.ndarray, value: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Distinct keys, how often each occurs, and the sum of its values."""
    t = pa.table([pa.array(key), pa.array(key if value is None else value)], names=["key", "value"])
    found = t.group_by("key", use_threads=False).aggregate([([], "count_all")] + ([] if value is None else [("value", "sum")]))
    return tuple(found.column(c).to_numpy() for c in ("key", "count_all", "value_sum")[:2 if value is None else 3])


def _numbered(names: list) -> tuple[np.ndarray, list]:
    """The number of each name in the list of distinct names, and that list."""
    number = {p: i for i, p in enumerate(dict.fromkeys(names))}
    return np.fromiter(map(number.__getitem__, names), dtype=np.int64, count=len(names)), list(number)


def chunk_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Per block of documents: lang, chunk, docs (of the block that hold it)."""
    def run(batches):
        for batch in batches:
            for b, data, bounds in blocks(batch, "text", COUNT_BLOCK):
                row, code, chunks = _chunks_of(data, bounds)
                group, langs = _numbered(b.column("lang").to_pylist())
                n = max(1, len(chunks))
                key, count = _sums(group[row] * n + code)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(langs, pa.string()).take(pa.array(key // n)), chunks.take(pa.array(key % n)), pa.array(count)],
                    names=["lang", "chunk", "docs"])

    return _rows(docs, text_col, lang_col, source_col).mapInArrow(run, "lang string, chunk string, docs long")


def term_parts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Written once: lang, chunk, term, times (the term's in the chunk), docs (that hold the chunk).

    Dealt out by chunk once and added up once; a chunk is cut in each language that has it, without another grouping.
    """
    dealt = chunk_counts(docs, text_col, lang_col, source_col).where(F.col("chunk").isNotNull()).repartition("chunk")
    counts = dealt.groupBy("chunk", "lang").agg(F.sum("docs").alias("docs"))
    cut = counts.withColumn("terms", F.regexp_extract_all("chunk", F.lit(TERM), F.lit(0)))
    # outer: a plain explode adds a filter that would cut every chunk a second time
    parts = cut.select("*", F.explode_outer(F.array_distinct("terms")).alias("term")).where(F.col("term").isNotNull())
    times = (F.size("terms") - F.size(F.array_remove("terms", F.col("term")))).cast("long")
    return written(parts.select("lang", "chunk", "term", times.alias("times"), "docs"), "audit-parts")


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                min_documents: int = MIN_DOCUMENTS) -> tuple[DataFrame, DataFrame]:
    """(lang, source, term, count) and (lang, term) of the terms in ``min_documents`` documents of the language at least."""
    parts = term_parts(docs, text_col, lang_col, source_col)
    bounds_of = parts.groupBy("lang", "term").agg(F.max("docs").alias("least"), F.sum("docs").alias("most"))
    bounds_of = written(bounds_of.where(F.col("most") >= min_documents).select(
        "lang", "term", (F.col("least") < min_documents).alias("undecided")), "audit-bounds")
    context = docs.sparkSession.sparkContext
    hashes = bounds_of.select(F.xxhash64("lang", "term").alias("h"), "undecided")
    terms = context.broadcast((hash_set(hashes, "h"), hash_set(hashes.where("undecided"), "h")))

    def pick(b):
        h = b.column("h").to_numpy().view(np.uint64)
        use, undecided = (held(h, members) for members in terms.value)
        b = b.append_column("undecided", pa.array(undecided)).filter(pa.array(use))
        hashes = string_hashes(b.column("chunk"))
        chunk = pc.if_else(pa.array(held(hashes, shared.value)), b.column("chunk"), "")
        yield pa.RecordBatch.from_arrays(
            [b.column("lang"), chunk, b.column("term"), b.column("times"), b.column("undecided"), pa.array(hashes.view(np.int64))],
            names=["lang", "chunk", "term", "times", "undecided", "h"])

    # chunks whose hash another chunk has too travel with their text, the others as their hash
    shared = context.broadcast(hash_set(_shared_hashes(parts), "h", bits=SHARED_BITS))
    # a hash set may let a term pass, or name it undecided, that is not: its documents are counted, so the answer stays
    wanted = written(arrow_map(parts.select("lang", "chunk", "term", "times", F.xxhash64("lang", "term").alias("h")), pick,
                               "lang string, chunk string, term string, times long, undecided boolean, h long"),
                     "audit-wanted")
    look_for = context.broadcast((hash_set(wanted, "h"), hash_set(wanted.where("undecided"), "h"), shared.value))

    def run(batches):
        before = TaskContext.get().partitionId() << 33
        sums = _Sums()
        for batch in batches:
            for b, data, bounds in blocks(batch, "text"):
                row, code, count, h, text, marks = _hashes_of(data, bounds, *look_for.value)
                group, names = _numbered(list(zip(b.column("lang").to_pylist(), b.column("source").to_pylist())))
                langs, sources = (pa.array([p[k] for p in names], pa.string()) for k in (0, 1))
                n = max(1, len(h))
                key, _, occ = _sums(group[row] * n + code, count)
                # those with a text of their own are few and go on as they are, the others are added up over blocks
                bare = np.asarray(pc.equal(text, ""))[key % n] if len(h) else np.zeros(0, dtype=bool)
                sums.add(names, key[bare] // n, h[key[bare] % n], occ[bare])
                key, occ = key[~bare], occ[~bare]
                named = np.flatnonzero(marks[code])
                for at, of, times, place in (
                        (key // n, key % n, pa.array(occ), pa.nulls(len(key), pa.int64())),
                        (group[row[named]], code[named], pa.nulls(len(named), pa.int64()), pa.array(before + row[named]))):
                    if len(at):
                        yield pa.RecordBatch.from_arrays(
                            [langs.take(pa.array(at)), sources.take(pa.array(at)), pa.array(h[of].view(np.int64)),
                             text.take(pa.array(of)), times, place], names=FOUND)
                if sums.full():
                    yield from sums.taken()
                before += b.num_rows
        yield from sums.taken()

    # sums per group and chunk, and beside them one row per document for the terms to be counted exactly
    found = _rows(docs, text_col, lang_col, source_col).mapInArrow(
        run, "lang string, source string, h long, chunk string, occ long, row long")
    # dealt out first: the blocks of a task are added up already, a partial sum before the shuffle would find little to add
    found = found.repartition("lang", "h", "chunk").groupBy("lang", "source", "h", "chunk", "row").agg(F.sum("occ").alias("occ"))
    found = written(found.join(bounded_broadcast(wanted), ["lang", "h", "chunk"]).select(
        "lang", "source", "term", (F.col("occ") * F.col("times")).alias("occ"), "row", "undecided"), "audit-found")
    exact = found.where(F.col("undecided") & F.col("row").isNotNull()).select("lang", "term", "row").distinct().groupBy(
        "lang", "term").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_documents)
    kept = written(bounds_of.where(~F.col("undecided")).select("lang", "term").union(
        exact.select("lang", "term")).distinct(), "audit-kept")
    counts = found.where(F.col("row").isNull()).groupBy("lang", "source", "term").agg(F.sum("occ").alias("count"))
    return written(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "count"), "audit-counts"), kept


def _share(count: Column, total: Column, n_terms: Column, smoothing: int, unit: int) -> Column:
    """1 + floor(unit * (count + smoothing) / (total + smoothing * n_terms)), exactly, as a long."""
    big = "decimal(19,0)"
    return F.call_function("div", (count + smoothing).cast(big) * F.lit(unit).cast("decimal(12,0)"),
                           total.cast(big) + n_terms.cast(big) * F.lit(smoothing).cast("decimal(6,0)")).cast("long") + 1


def shares(docs: DataFrame, counts: DataFrame, kept: DataFrame, lang_col: str = "lang",
           source_col: str = "source", smoothing: int = SMOOTHING, unit: int = UNIT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Groups (lang, source, total, n_terms, unseen: the share of a term without occurrences), written once;
    group terms (lang, source, term, p) with an occurrence, and language terms (lang, term, q)."""
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in (
        (lang_col, "lang"), (source_col, "source"))]).distinct()
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    zero = F.lit(0).cast("long")
    groups = groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").select(
        "lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("n_terms", zero).alias("n_terms"))
    groups = written(groups.withColumn("unseen", F.when(F.col("n_terms") > 0, _share(
        zero, F.col("total"), F.greatest("n_terms", F.lit(1)), smoothing, unit))), "audit-groups")
    own = counts.join(groups.drop("unseen"), ["lang", "source"]).select("lang", "source", "term", _share(
        F.col("count"), F.col("total"), F.col("n_terms"), smoothing, unit).alias("p"))
    whole = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("n_terms").alias("n_terms"))
    of_lang = counts.groupBy("lang", "term").agg(F.sum("count").alias("count")).join(whole, "lang").select(
        "lang", "term", _share(F.col("count"), F.col("total"), F.col("n_terms"), smoothing, unit).alias("q"))
    return groups, own, of_lang


def pair_differences(groups: DataFrame, own: DataFrame, cells: int = CELLS) -> DataFrame:
    """lang, source, other, value: the summed absolute difference of shares over all kept terms.

    The terms of a language are dealt into blocks of about ``cells`` cells (terms
    times sources); a task holds one block as a dense matrix, unseen terms with
    the source's share of an unseen term, and adds up each pair of rows.
    """
    size = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"), F.max("n_terms").alias("n_terms"))
    size = size.select("lang", F.ceil((F.col("sources") * F.col("n_terms") + 1) / cells).cast("int").alias("parts"))
    dealt = own.join(size, "lang").select("lang", F.pmod(F.xxhash64("term"), F.col("parts")).cast("int").alias("part"),
                                          "source", "term", "p")
    each = groups.join(size, "lang").select("lang", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                                            "source", F.lit(None).cast("string").alias("term"), F.coalesce(
                                                "unseen", F.lit(0).cast("long")).alias("p"))

    def differences(key, t):
        terms, sources = t.column("term").combine_chunks(), t.column("source").combine_chunks()
        p = t.column("p").to_numpy()
        head = np.asarray(terms.is_null())
        names = sources.filter(pa.array(head))
        place = {s: i for i, s in enumerate(names.to_pylist())}
        column = terms.filter(pa.array(~head)).dictionary_encode()
        matrix = np.repeat(p[head][:, None], len(column.dictionary), axis=1)
        row = np.fromiter((place[s] for s in sources.filter(pa.array(~head)).to_pylist()), dtype=np.int64, count=len(column))
        matrix[row, column.indices.to_numpy(zero_copy_only=False)] = p[~head]
        n = len(names)
        value = np.array([np.abs(matrix - matrix[i]).sum(axis=1) for i in range(n)]).reshape(n, n)
        a, b = np.nonzero(~np.eye(n, dtype=bool))
        lang = pa.array([key[0].as_py()] * len(a), pa.string())
        return pa.table([lang, names.take(pa.array(a)), names.take(pa.array(b)), pa.array(value[a, b])],
                        names=["lang", "source", "other", "value"])

    parts = dealt.unionByName(each).groupBy("lang", "part").applyInArrow(
        differences, "lang string, source string, other string, value long")
    return parts.groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: every other source by its distance (``pair``), and the terms the
    source uses more than its language does (``term``, the first ``top_terms``)."""
    counts, kept = term_counts(docs, text_col, lang_col, source_col, min_documents)
    groups, own, of_lang = shares(docs, counts, kept, lang_col, source_col)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_differences(groups, own).select(
        "lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value")
    more = own.join(of_lang, ["lang", "term"]).where(F.col("p") > F.col("q")).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    rank = F.row_number().over(order)
    return pairs.withColumn("rank", rank).unionByName(more.withColumn("rank", rank).where(F.col("rank") <= top_terms))
