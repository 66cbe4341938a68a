"""Substring dedup: paragraph MinHash banding, exact verification, components.

Paragraphs.  A pasted passage stands anywhere, also inside a line, so paragraphs
follow the words, not the lines: a cut falls before the word whose hash with the
word ahead of it is the least of some ``SPREAD`` neighbours in a row
(:func:`cuts`).  Cuts depend on the words around them alone; two of them are at
most ``SPREAD`` words apart, about half of that on average, and any run of
2 * ``SPREAD`` words holds a whole paragraph of its own.

Each paragraph's set of 5-word shingles (A-Z lower-cased) gets a MinHash signature
cut into bands of ``ROWS`` values; paragraphs that share a band are candidates, and
a pair is linked when the exact Jaccard similarity of their shingle sets is 0.8 or
more.  Bands are tuned for recall: :func:`tuned_bands` takes the least number that
misses a pair at the threshold with probability ``MISS`` at most.  Linked
paragraphs form classes (connected components); equal paragraphs are one node.

A passage is a run of paragraphs, one after the other in a document, whose
classes all occur elsewhere; it counts when it has at least
``MIN_PASSAGE_WORDS`` words.  A shorter run is extended word by word: around its
longest paragraph it is compared with another place of that paragraph, and it
counts when the longest equal run of words there is long enough
(:func:`extended`).  Of a class, the earliest paragraph (least document id, then
place) stays and the others are removed, passage by passage.

First filter.  Most paragraphs share no band with any other.  Equal paragraphs are
counted first, as a hash with their band values, so a copy shares no band with
itself.  Band values of different paragraphs are counted as bare numbers; those
that occur twice go to the tasks as a hash set of fixed size, and the paragraphs that
hold one are the candidates.  Places are not kept meanwhile: once classes are known
the texts are parsed again, and only paragraphs that repeat go on, by a hash set of
those with a copy or a link.

Memory.  A task parses ``PIECE`` bytes of text at a time, as the arrays of a piece
take some sixty times its bytes, and cuts out so many bytes of runs at a time.  No
stage has two Python steps.

Crowded bands.  Candidates that cannot have a partner, because too many of their
shingles occur in no other candidate, leave first.  A band value held by at
most ``CROWD`` different paragraphs yields its pairs.  In a fuller one every
paragraph is verified against one hub, the most frequent paragraph (a star);
then paragraphs of different components are compared when they share one of
their rarest shingles (the prefix filter, which loses no pair).  Pairs inside
one component need no comparison, so nothing is lost, and a group of thousands
of near copies costs about one comparison each.

Texts of candidates are read again by the hash of their words, those around short
runs by the hash of their document's text, so that rows without an id, or with the
same one, stay apart.

Defined cases: null and empty texts have no paragraphs; null ids come last;
repeated rows are copies of each other; rows that share an id are compared like
any others; a text of any length is read whole; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from starling.llm.common import WORD, arrow_map, bounded_broadcast, edges_to_components, text_or_empty, written
from starling.llm.text_bytes import blocks, byte_class, gather, hash_set, held, mix, powers, spans, word_hashes

SHINGLE, SIMILARITY = 5, 0.8
SPREAD, MIN_PASSAGE_WORDS = 24, 50
ROWS, MISS = 2, 2e-2
CROWD = 8
STEP = 256
#: Bytes of text a task parses at a time.
PIECE = 1 << 20

WORD_BYTES = byte_class(" \t\n\x0b\x0c\r", inverted=True)
_LAST = np.uint64(2**64 - 1)


def tuned_bands(similarity: float = SIMILARITY, miss: float = MISS, rows: int = ROWS) -> int:
    """The least number of bands that misses a pair at ``similarity`` with probability ``miss`` at most."""
    return math.ceil(math.log(miss) / math.log(1 - similarity ** rows))


def _numbers(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit multipliers."""
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_PLACE = _numbers(SHINGLE, 1)


def cuts(h: np.ndarray, row: np.ndarray, spread: int) -> np.ndarray:
    """The first words of all paragraphs, for words with hashes ``h`` of texts ``row``.

    The first word of a text has the least value, so no choice depends on the text before it.
    """
    if not len(h):
        return np.zeros(0, dtype=np.int64)
    value = np.zeros(len(h), dtype=np.uint64)
    value[1:] = mix(h[:-1] * _PLACE[0] + h[1:] * _PLACE[1]) | np.uint64(1)
    first = np.append(True, row[1:] != row[:-1])
    value[first] = 0
    chosen = first.copy()
    if len(h) >= spread:
        least = np.lib.stride_tricks.sliding_window_view(value, spread).argmin(axis=1)
        chosen[np.arange(len(least)) + least] = True
    return np.flatnonzero(chosen)


def band_values(h: np.ndarray, start: np.ndarray, node: np.ndarray, bands: int) -> np.ndarray:
    """One row of band values per paragraph: each from the least of its shingle hashes under ``ROWS`` hashes."""
    stop = np.append(start[1:], len(h))
    shingle = np.zeros(len(h), dtype=np.uint64)
    for k in range(SHINGLE):
        shingle[:len(h) - k] += h[k:] * _PLACE[k]
    inside = np.arange(len(h)) + SHINGLE <= np.repeat(stop, stop - start)
    shingle[start] = np.where(stop - start < SHINGLE, node, shingle[start])  # a short paragraph is one shingle
    inside[start] = True
    out = np.empty((len(start), bands), dtype=np.uint64)
    factors = _numbers(bands * ROWS, 2)
    for b in range(bands):
        value = np.full(len(start), b, dtype=np.uint64)
        for factor in factors[b * ROWS:(b + 1) * ROWS]:
            value = mix(value * np.uint64(31) + np.minimum.reduceat(np.where(inside, mix(shingle * factor), _LAST), start))
        out[:, b] = value
    return out


def _parsed(data: np.ndarray, bounds: np.ndarray, spread: int):
    """Words of a block (start, end, row, hash) and its paragraphs (first word, row, number in the row, words, node)."""
    begin, end, row = spans(data, bounds, WORD_BYTES)
    h = word_hashes(data, begin, end)
    start = cuts(h, row, spread)
    of = row[start]
    first_of = np.searchsorted(of, np.arange(len(bounds) - 1))  # first paragraph of each row
    n = np.diff(np.append(start, len(h)))
    total = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * powers(len(h)), out=total[1:])
    node = mix((total[start + n] - total[start]) * powers(len(h), inverse=True)[start] + n.astype(np.uint64)) if len(h) else h
    return begin, end, row, h, start, of, np.arange(len(start)) - first_of[of], n, node


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.withColumn("content", F.xxhash64("text"))


def _node_rows(batch: pa.RecordBatch, bands: int, spread: int):
    """Record batches with h1 and the band values of every paragraph."""
    for _, data, bounds in blocks(batch, "text", PIECE):
        _, _, _, h, start, _, _, _, node = _parsed(data, bounds, spread)
        if len(start):
            keys = band_values(h, start, node, bands)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.view(np.int64)) for x in (node, *np.ascontiguousarray(keys.T))], names=["h1", *_names(bands)])


def distinct_paragraphs(docs: DataFrame, id_col: str, text_col: str, bands: int, spread: int) -> DataFrame:
    """Written once: every different paragraph: h1, its number of ``copies`` and the band values k0, k1 and so on."""
    rows = arrow_map(_rows(docs, id_col, text_col).select("text"), lambda b: _node_rows(b, bands, spread),
                     "h1 long, " + ", ".join(f"{k} long" for k in _names(bands)))
    return written(rows.groupBy("h1").agg(
        F.count(F.lit(1)).alias("copies"), *[F.min(k).alias(k) for k in _names(bands)]),
        "paragraph-nodes")  # equal paragraphs have equal values


def _met(nodes: DataFrame, bands: int) -> DataFrame:
    """Written once: key, h1, copies of every band value that another paragraph has too."""
    keys = nodes.select(F.explode(F.array(*_names(bands))).alias("key")).groupBy("key").agg(
        F.count(F.lit(1)).alias("c")).where("c > 1")
    keys = written(keys.select("key"), "paragraph-keys")
    wanted = nodes.sparkSession.sparkContext.broadcast(hash_set(keys, "key"))

    def run(b):
        values = np.stack([b.column(k).to_numpy() for k in _names(bands)], axis=1).view(np.uint64)
        at, band = np.nonzero(held(values.ravel(), wanted.value).reshape(values.shape))
        of = pa.array(at)
        yield pa.RecordBatch.from_arrays(
            [pa.array(values[at, band].view(np.int64)), b.column("h1").take(of), b.column("copies").take(of)],
            names=["key", "h1", "copies"])

    keyed = arrow_map(nodes.select("h1", "copies", *_names(bands)), run, "key long, h1 long, copies long")
    return written(keyed.join(keys, "key", "left_semi"), "paragraph-met")


def shared_paragraphs(docs: DataFrame, repeated: DataFrame, id_col: str, text_col: str, spread: int) -> DataFrame:
    """Written once: the places of the ``repeated`` paragraphs (h1) (some others may stay too).

    doc_id, row (of the input), content (hash of the text), no, start (first word), n (words) and h1.
    """
    rows = _rows(docs, id_col, text_col)
    wanted = docs.sparkSession.sparkContext.broadcast(hash_set(repeated, "h1"))

    def run(batches):
        before = TaskContext.get().partitionId() << 33
        for batch in batches:
            for b, data, bounds in blocks(batch, "text", PIECE):
                _, _, row, _, start, of, no, n, node = _parsed(data, bounds, spread)
                if len(start):
                    use = np.flatnonzero(held(node, wanted.value))
                    first_word = start - np.searchsorted(row, of)
                    at = pa.array(of[use])
                    yield pa.RecordBatch.from_arrays(
                        [b.column("doc_id").take(at), pa.array(before + of[use]), b.column("content").take(at),
                         pa.array(no[use], pa.int32()), pa.array(first_word[use], pa.int64()), pa.array(n[use], pa.int32()),
                         pa.array(node[use].view(np.int64))],
                        names=["doc_id", "row", "content", "no", "start", "n", "h1"])
                before += b.num_rows

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return written(rows.mapInArrow(run, f"doc_id {id_type}, row long, content long, no int, start long, n int, h1 long"),
                   "paragraph-shared")


def _names(bands: int) -> list[str]:
    return [f"k{b}" for b in range(bands)]


def _spaced(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words one after the other, a space behind each, and where each begins (and the end)."""
    size = end - begin + 1
    place = np.concatenate(([0], np.cumsum(size)))
    index = np.repeat(begin - place[:-1], size) + np.arange(place[-1])
    out = np.append(data, np.uint8(32))[index]
    out[place[1:] - 1] = 32
    return out, place


def _candidate_texts(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, spread: int) -> DataFrame:
    """Written once: h1, words (lower-cased, space between) of the ``wanted`` paragraphs (h1).

    The texts are parsed again with the wanted hashes as a hash set of fixed size; texts are not shuffled.
    """
    members = docs.sparkSession.sparkContext.broadcast(hash_set(wanted, "h1"))

    def run(batches):
        for batch in batches:
            for _, data, bounds in blocks(batch, "text", PIECE):
                begin, end, _, _, start, _, _, n, node = _parsed(data, bounds, spread)
                if not len(start):
                    continue
                use = np.flatnonzero(held(node, members.value))
                _, first = np.unique(node[use], return_index=True)
                use = use[first]
                at = np.concatenate(([0], np.cumsum(n[use])))  # first word of each, among their words
                words = np.repeat(start[use] - at[:-1], n[use]) + np.arange(at[-1])
                spaced, place = _spaced(data, begin[words], end[words])
                yield pa.RecordBatch.from_arrays([pa.array(node[use].view(np.int64)), gather(
                    spaced, place[at[:-1]], place[at[1:]] - 1)], names=["h1", "words"])

    found = _rows(docs, id_col, text_col).select("text").mapInArrow(run, "h1 long, words string").dropDuplicates(["h1"])
    return written(found.join(wanted.select("h1"), "h1", "left_semi"), "paragraph-texts")


def _cut_runs(batch: pa.RecordBatch):
    """Record batches of about ``PIECE`` bytes with content, first, stop, words of the ``places`` of every text.

    The first place of a class has a run for each way others lie around it, so a text may have very many.
    """
    for b, data, bounds in blocks(batch, "text", PIECE):
        begin, end, row = spans(data, bounds, WORD_BYTES)
        spaced, place = _spaced(data, begin, end)
        lo = np.searchsorted(row, np.arange(b.num_rows))
        hi = np.searchsorted(row, np.arange(b.num_rows), side="right")
        lists = b.column("places")
        runs = lists.flatten()
        of = np.repeat(np.arange(b.num_rows), np.diff(np.asarray(lists.offsets)))
        first, stop = (runs.field(k).to_numpy() for k in (0, 1))
        a = place[np.clip(lo[of] + first, lo[of], hi[of])]
        z = np.maximum(place[np.clip(lo[of] + stop, lo[of], hi[of])] - 1, a)
        cut = np.flatnonzero(np.diff(np.cumsum(z - a) // PIECE)) + 1
        for x, y in zip([0, *cut], [*cut, len(of)]):
            yield pa.RecordBatch.from_arrays(
                [b.column("content").take(pa.array(of[x:y])), runs.field(0)[x:y], runs.field(1)[x:y],
                 gather(spaced, a[x:y], z[x:y])], names=["content", "first", "stop", "words"])


def _word_runs(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, purpose: str) -> DataFrame:
    """Written once: content, first, stop, words (lower-cased, space between) of the ``wanted`` runs of words
    (content, first, stop) of texts.  Unless the list of runs is broadcast, texts without one are left out, by a
    hash set, before the shuffle."""
    places = wanted.groupBy("content").agg(F.collect_set(F.struct("first", "stop")).alias("places"))
    places = written(places, f"{purpose}-places")
    rows, side = _rows(docs, id_col, text_col).select("content", "text"), bounded_broadcast(places)
    if side is places:
        members = docs.sparkSession.sparkContext.broadcast(hash_set(places, "content"))

        def needed(b):
            yield b.filter(pa.array(held(b.column("content").to_numpy().view(np.uint64), members.value)))

        rows = arrow_map(rows, needed, "content long, text string")
    rows = rows.join(side, "content")

    found = arrow_map(rows, _cut_runs, "content long, first long, stop long, words string")
    return written(found.dropDuplicates(["content", "first", "stop"]), purpose)


def shingles(words: bytes) -> np.ndarray:
    """Distinct shingle hashes of a paragraph; fewer words than a shingle make one."""
    words = words.split(b" ")
    n = max(1, len(words) - SHINGLE + 1)
    return np.unique(np.array([xxhash.xxh3_64_intdigest(b" ".join(words[i:i + SHINGLE])) for i in range(n)], dtype=np.uint64))


def _shingle_sets(texts: DataFrame) -> DataFrame:
    """Written once: h1, ``set`` (shingle hashes) of the candidate paragraphs."""
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, STEP):
                piece = b.slice(at, STEP)
                sets = [shingles(x).view(np.int64) for x in piece.column("words").cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([piece.column("h1"), pa.array(sets, pa.list_(pa.int64()))],
                                                 names=["h1", "set"])
    return written(texts.select("h1", "words").mapInArrow(run, "h1 long, set array<bigint>"), "paragraph-sets")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``(src, dst)`` whose exact Jaccard similarity reaches the threshold."""
    a = sets.select(F.col("h1").alias("src"), F.col("set").alias("a"))
    b = sets.select(F.col("h1").alias("dst"), F.col("set").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    return pairs.join(a, "src").join(b, "dst").where(
        both >= similarity * (F.size("a") + F.size("b") - both)).select("src", "dst")


def _with_partners(sets: DataFrame, similarity: float) -> DataFrame:
    """Shingles of the paragraphs that can have a partner: (h1, n, shingle, df).

    A partner shares ``similarity`` of a paragraph's shingles at least, so a
    paragraph with too many shingles that no other candidate has is left out.
    """
    each = sets.select("h1", F.size("set").alias("n"), F.explode("set").alias("shingle"))
    df = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("df"))
    known = written(each.join(df, "shingle"), "paragraph-shingles")
    strong = known.groupBy("h1", "n").agg(F.count_if(F.col("df") > 1).alias("held")).where(
        F.col("held") >= similarity * F.col("n")).select("h1")
    return written(known.join(strong, "h1", "left_semi"), "paragraph-strong")


def _prefix_pairs(shingles_of: DataFrame, placed: DataFrame, similarity: float) -> DataFrame:
    """Candidate pairs in different components, by the prefix filter.

    Two sets with Jaccard similarity s or more share one of the (1 - s) n + 1
    shingles that come first in any common order; here the rarest come first.
    At the first one they share, at places p and q, at most 1 + min(m - p, n - q)
    are shared in all, which must reach s / (1 + s) (m + n).  Of a shingle's
    paragraphs, those outside its largest component are paired with the others.
    """
    order = Window.partitionBy("h1").orderBy("df", "shingle")
    first = shingles_of.join(placed, "h1").withColumn("r", F.row_number().over(order)).where(
        F.col("r") <= F.col("n") - F.ceil(F.col("n") * similarity - 1e-9) + 1).select("shingle", "h1", "n", "c", "r")
    first = written(first, "paragraph-prefix")
    largest = first.groupBy("shingle", "c").agg(F.count(F.lit(1)).alias("k")).groupBy("shingle").agg(
        F.max(F.struct("k", "c")).alias("top"), F.count(F.lit(1)).alias("parts")).where("parts > 1").select(
        "shingle", F.col("top.c").alias("main"))
    outside = first.join(largest, "shingle").where("c != main").select(
        "shingle", F.col("h1").alias("src"), F.col("c").alias("sc"), F.col("n").alias("sn"), F.col("r").alias("sr"))
    rest = first.select(F.col("shingle").alias("t"), F.col("h1").alias("dst"), F.col("c").alias("dc"),
                        F.col("n").alias("dn"), F.col("r").alias("dr"))
    room = F.least(F.col("sn") - F.col("sr"), F.col("dn") - F.col("dr")) + 1
    return outside.join(rest, (F.col("shingle") == F.col("t")) & (F.col("sc") != F.col("dc")) & (
        room >= similarity / (1 + similarity) * (F.col("sn") + F.col("dn")) - 1e-9)).select(
        F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))


def classes(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, bands: int, spread: int,
            similarity: float = SIMILARITY, crowd: int = CROWD) -> DataFrame:
    """``(node, component)``: the class of every paragraph (hash) with a verified link to another one."""
    met = _met(nodes, bands)
    wanted = written(met.select("h1").distinct(), "paragraph-wanted")
    sets = _shingle_sets(_candidate_texts(docs, wanted, id_col, text_col, spread))
    strong = _with_partners(sets, similarity)

    # the hub of a band is its most frequent paragraph: copies with edits lie around it
    members = written(met.join(strong.select("h1").distinct(), "h1", "left_semi"), "paragraph-members")
    held_by = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("copies", "h1")).alias("top")).where("n > 1")
    met = written(members.select("key", "h1").join(held_by.select("key", "n", F.col("top.h1").alias("hub")), "key"),
                  "paragraph-bands")
    few, full = met.where(F.col("n") <= crowd), met.where(F.col("n") > crowd)
    other = few.select(F.col("key").alias("k"), F.col("h1").alias("dst"))
    pairs = few.select("key", F.col("h1").alias("src")).join(
        other, (F.col("key") == F.col("k")) & (F.col("src") < F.col("dst"))).select("src", "dst")
    star = full.where("h1 != hub").select(F.least("hub", "h1").alias("src"), F.greatest("hub", "h1").alias("dst"))
    first = written(_verified(pairs.union(star).distinct(), sets, similarity), "paragraph-links")
    label = written(edges_to_components(first), "paragraph-labels")

    placed = written(full.select("h1").distinct().join(label, F.col("h1") == F.col("node"), "left").select(
        "h1", F.coalesce("component", "h1").alias("c")), "paragraph-placed")
    cross = written(_verified(_prefix_pairs(strong, placed, similarity).distinct(), sets, similarity), "paragraph-cross")
    if cross.isEmpty():
        return label
    # the components that the last links join
    of_src = label.select(F.col("node").alias("src"), F.col("component").alias("s"))
    of_dst = label.select(F.col("node").alias("dst"), F.col("component").alias("d"))
    met = cross.join(of_src, "src", "left").join(of_dst, "dst", "left").select(
        "src", "dst", F.coalesce("s", "src").alias("s"), F.coalesce("d", "dst").alias("d"))
    met = written(met, "paragraph-joined")
    joined = written(edges_to_components(met.select(F.col("s").alias("src"), F.col("d").alias("dst"))).toDF("at", "into"),
                     "paragraph-into")
    linked = label.union(met.select("src", "s")).union(met.select("dst", "d")).distinct()
    return written(linked.join(joined, F.col("component") == F.col("at"), "left").select(
        "node", F.coalesce("into", "component").alias("component")), "paragraph-linked")


def _place(*more: str) -> Column:
    """Places in their order: documents by id, without one last."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "start", "row", *more)


def extended(docs: DataFrame, runs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """(row, run, words): the short ``runs`` whose longest equal run of words with the other place is long enough.

    ``runs``: row, run, content, start, stop, and at (content, start) the longest paragraph's other place
    ``other_content``, ``other_start``, its own start ``seed``.  Both texts are cut out ``min_words`` around
    the run, laid on each other at the paragraph, and compared word by word to both sides.
    """
    around = runs.select("row", "run", "content", "other_content",
                         F.greatest(F.col("start") - min_words, F.lit(0)).alias("first"),
                         (F.col("stop") + min_words).alias("stop"), "seed",
                         F.greatest(F.col("other_start") - (F.col("seed") - F.col("start")) - min_words,
                                    F.lit(0)).alias("other_first"),
                         (F.col("other_start") + (F.col("stop") - F.col("seed")) + min_words).alias("other_stop"), "other_start")
    around = written(around, "paragraph-short")
    wanted = around.select("content", "first", "stop").union(
        around.select("other_content", "other_first", "other_stop")).distinct()
    texts = _word_runs(docs, wanted, id_col, text_col, "paragraph-around")
    mine = around.join(texts, ["content", "first", "stop"]).withColumnRenamed("words", "mine")
    both = mine.join(texts.toDF("other_content", "other_first", "other_stop", "theirs"),
                     ["other_content", "other_first", "other_stop"])

    def run(b):
        out = []
        for mine_, theirs, i, j in zip(*[b.column(c).to_pylist() for c in ("mine", "theirs", "at", "other_at")]):
            x, y = mine_.split(" "), theirs.split(" ")
            right = 0
            while i + right < len(x) and j + right < len(y) and x[i + right] == y[j + right]:
                right += 1
            left = 0
            while left < min(i, j) and x[i - left - 1] == y[j - left - 1]:
                left += 1
            out.append(left + right)
        yield pa.RecordBatch.from_arrays([b.column("row"), b.column("run"), pa.array(out, pa.int64())],
                                         names=["row", "run", "words"])

    both = both.select("row", "run", "mine", "theirs", (F.col("seed") - F.col("first")).alias("at"),
                       (F.col("other_start") - F.col("other_first")).alias("other_at"))
    return arrow_map(both, run, "row long, run long, words long").where(F.col("words") >= min_words)


def passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
             min_passage_words: int = MIN_PASSAGE_WORDS, spread: int = SPREAD, miss: float = MISS,
             crowd: int = CROWD) -> DataFrame:
    """One row per paragraph of a repeated passage: doc_id, start_word, n_words, passage_words,
    keep_doc_id, keep_start_word (the paragraph of its class that stays) and removed."""
    bands = tuned_bands(similarity, miss)
    nodes = distinct_paragraphs(docs, id_col, text_col, bands, spread)
    class_of = classes(docs, nodes, id_col, text_col, bands, spread, similarity, crowd)
    again = nodes.where("copies > 1").select("h1").union(class_of.select("node"))
    shared = shared_paragraphs(docs, again, id_col, text_col, spread)
    placed = written(shared.join(class_of, F.col("h1") == F.col("node"), "left").select(
        "doc_id", "row", "content", "no", "start", "n", F.coalesce("component", "h1").alias("class")), "paragraph-classes")
    repeated = placed.groupBy("class").agg(F.min(_place()).alias("keep"), F.count(F.lit(1)).alias("members")).where("members > 1")
    marked = placed.join(repeated.select("class", "keep"), "class")
    # a run: repeated paragraphs of one row with no other paragraph between them
    marked = marked.withColumn("run", F.col("no") - F.row_number().over(Window.partitionBy("row").orderBy("no")))
    marked = written(marked.withColumn("run", F.col("run").cast("long")).withColumn(
        "passage_words", F.sum("n").over(Window.partitionBy("row", "run"))), "paragraph-runs")

    short = marked.where((F.col("passage_words") < min_passage_words)).groupBy("row", "run", "content").agg(
        F.min("start").alias("start"), F.max(F.col("start") + F.col("n")).alias("stop"),
        F.max(F.struct("n", F.col("start").alias("seed"), "class")).alias("top")).where(F.col("top.n") >= SHINGLE)
    short = short.select("row", "run", "content", "start", "stop", F.col("top.seed").alias("seed"), F.col("top.class").alias("class"))
    # the other place of the longest paragraph: the first one of its class, or the last for the first itself
    ends = placed.join(short.select("class").distinct(), "class", "left_semi").groupBy("class").agg(
        F.min(_place("content")).alias("low"), F.max(_place("content")).alias("high"))
    own = (F.col("low.row") == F.col("row")) & (F.col("low.start") == F.col("seed"))
    short = short.join(ends, "class").withColumn("other", F.when(own, F.col("high")).otherwise(F.col("low"))).select(
        "row", "run", "content", "start", "stop", "seed", F.col("other.content").alias("other_content"),
        F.col("other.start").alias("other_start"))
    longer = extended(docs, short, id_col, text_col, min_passage_words)
    found = marked.where(F.col("passage_words") >= min_passage_words).unionByName(
        marked.drop("passage_words").join(longer.withColumnRenamed("words", "passage_words"), ["row", "run"]))
    return found.select(
        F.col("doc_id").alias(id_col), F.col("start").alias("start_word"), F.col("n").alias("n_words"), "passage_words",
        F.col("keep.doc_id").alias("keep_doc_id"), F.col("keep.start").alias("keep_start_word"),
        ((F.col("row") != F.col("keep.row")) | (F.col("start") != F.col("keep.start"))).alias("removed"))


def remove_passages(text: Column, removed: Column) -> Column:
    """A document's words without those of the paragraphs in ``removed``: an array of (start_word, n_words)."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return F.array_join(F.filter(words, lambda _, i: ~F.exists(
        removed, lambda p: (i >= p.start_word) & (i < p.start_word + p.n_words))), " ")
