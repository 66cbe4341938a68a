"""Line dedup by a deletion-neighbourhood join: of lines within one edit, the earliest stays.

Lines are compared without white space at their ends; lines without a word are
left alone.  A line is dropped when the same line, or one within one character
edit of it (insertion, deletion or substitution), stands earlier; earlier means
a smaller document id, then a smaller line number.  Lines shorter than
``MIN_NEAR`` characters are compared exactly only ("a 1" and "a 2" are not
copies).

Neighbourhood.  Two lines are within one edit when they are equal after
deleting one character at the same place of each (substitution), or when one
equals the other after one deletion.  Each line emits hashed keys of these
variants, and equal keys join.  To emit few of them, a line is cut into
``SEGMENTS`` segments: an edit touches one, so partners agree on all the
others.  A first narrow pass hashes "all but segment i" of every distinct line
(for its own length, and for the length after a deletion).  For segments whose
context another line shares, the texts are read and the same is done with
segments a quarter as long; those that are still shared emit their variants.
Nothing is lost: the contexts of partners are equal by construction.

Groups.  All lines that share a substitution variant are within one edit of each
other, so the earliest of them is found by a minimum per key, without listing
pairs; a deletion variant equals at most one line.  Equal lines are one node.
Every link found is verified on the texts (``levenshtein``) before it counts.

Defined cases: null and empty texts have no lines; null ids come last;
rows are kept apart by their number, also without an id or with the same one
(rows equal in id and text are copies, of which one stays); a very long line is hashed by
prefix sums, in time proportional to its length; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starling.llm.common import written
from starling.llm.lines import STEP, first_places, line_table, line_texts

MIN_NEAR, SEGMENTS, REFINE = 20, 3, 4
FINE = SEGMENTS * REFINE
_P = np.uint64(0x9E3779B97F4A7C15)      # odd multiplier of the polynomial hash
_HEAD = np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads the polynomial sums over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers = np.ones(1, dtype=np.uint64)


def _powers_to(n: int) -> np.ndarray:
    """P**j for j < n at least."""
    global _powers
    if len(_powers) < n:
        more = np.full(max(n, 4096, 2 * len(_powers)), _P, dtype=np.uint64)
        more[0] = 1
        _powers = np.multiply.accumulate(more)
    return _powers


def prefix_sums(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sums, starts, lengths): ``sums[starts[i] + j] - sums[starts[i]]`` is the sum of
    code[k] * P**k over the first j characters of line i, modulo 2**64."""
    lengths = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
    codes = _mix(np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + _P)
    place = np.arange(len(codes)) - np.repeat(starts, lengths)
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * _powers_to(int(lengths.max(initial=0)) + 1)[place], out=sums[1:])
    return sums, starts, lengths


def context_keys(lines: list[str], segments: int) -> np.ndarray:
    """Per line, for its own length and for one less: hashes of all but segment i of ``segments``.

    For length m, the head is the line's first characters and the tail its last
    ones, so a partner that is one longer or shorter has the same head and tail.
    """
    sums, starts, lengths = prefix_sums(lines)
    base, end = sums[starts], sums[starts + lengths]
    out = np.empty((len(lines), 2 * segments), dtype=np.uint64)
    for role in (0, 1):
        m = lengths - role
        for i in range(segments):
            head = sums[starts + m * i // segments] - base
            tail = end - sums[starts + lengths - (m - m * (i + 1) // segments)]
            if role == 0:  # as if the tail began one place later, where it does in a longer partner
                tail = tail * _P
            out[:, role * segments + i] = _mix((head * _HEAD) ^ (tail + (m * segments + i).astype(np.uint64)))
    return out


def variants(line: str, shared: list[int], segments: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of the line's variants for its shared contexts: the line without the
    character at each place of the segment, and for its own length the whole line (place -1)."""
    sums, _, _ = prefix_sums([line])
    n = len(line)
    at = []
    for k in shared:
        m, i = n - k // segments, k % segments
        # a longer line's segment has one character more
        at.append(np.arange(m * i // segments, m * (i + 1) // segments + k // segments))
    at = np.unique(np.concatenate(at))
    # the characters behind a place move one to the left; instead, the head is scaled by one power
    less = _mix(sums[at] * _P + (sums[n:n + 1] - sums[at + 1]) + np.uint64(n - 1))
    if min(shared) >= segments:
        return less, at
    return np.append(less, _mix(sums[n:n + 1] * _P + np.uint64(n))), np.append(at, -1)


def _line_keys(lines: list[bytes]) -> list[list]:
    texts = [x.decode("utf-8", "replace") for x in lines]
    use = [i for i, x in enumerate(texts) if len(x) >= MIN_NEAR]
    keys: list = [None] * len(lines)
    if use:
        for i, row in zip(use, context_keys([texts[i] for i in use], SEGMENTS).view(np.int64)):
            keys[i] = row
    return [keys]


def _shared_contexts(keyed: DataFrame) -> DataFrame:
    """``(h1, shared)``: of the contexts (h1, k, key), those that another line has too."""
    held = keyed.groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a != b").select("key")
    return keyed.join(held, "key", "left_semi").groupBy("h1").agg(F.sort_array(F.collect_set("k")).alias("shared"))


def _fine_contexts(work: DataFrame) -> DataFrame:
    """``(h1, k, key)``: contexts of the fine segments inside the shared ones."""
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, STEP):
                piece = b.slice(at, STEP)
                lines = [x.decode("utf-8", "replace") for x in piece.column("line").to_pylist()]
                keys = context_keys(lines, FINE).view(np.int64)
                index, fine = [], []
                for i, shared in enumerate(piece.column("shared").to_pylist()):
                    for k in shared:
                        first = k // SEGMENTS * FINE + k % SEGMENTS * REFINE
                        index += [i] * REFINE
                        fine += range(first, first + REFINE)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("h1").take(pa.array(index, pa.int64())), pa.array(fine, pa.int32()),
                     pa.array(keys[index, fine])], names=["h1", "k", "key"])
    return work.select("h1", "line", "shared").mapInArrow(run, "h1 long, k int, key long")


def near_links(docs: DataFrame, lines: DataFrame, distinct: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Verified links of distinct lines: ``h1, h2`` of a line and ``e1, e2`` of an earlier one within one edit."""
    keyed = lines.where("keys is not null").select("h1", F.posexplode("keys").alias("k", "key"))
    found = written(distinct.select("h1", "h2", "doc_id", "line_no").join(_shared_contexts(keyed), "h1"), "line-shared")
    texts = line_texts(docs, found.select("h1", "h2", "doc_id", "line_no"), id_col, text_col, "line-texts")
    work = written(texts.join(found, ["h1", "h2"]), "line-work")
    fine = _shared_contexts(written(_fine_contexts(work), "line-fine"))
    emit = work.drop("shared").join(fine, "h1").select(
        "h1", "h2", "line", F.col("doc_id").isNull().alias("none"), "doc_id", "line_no", "shared")
    id_type = distinct.schema["doc_id"].dataType.simpleString()
    kept = ["h1", "h2", "none", "doc_id", "line_no"]

    def batch(batches):
        for b in batches:
            for at in range(0, b.num_rows, STEP):
                piece = b.slice(at, STEP)
                found_here = [variants(line.decode("utf-8", "replace"), own, FINE) for line, own in
                              zip(piece.column("line").to_pylist(), piece.column("shared").to_pylist())]
                take = pa.array(np.repeat(np.arange(len(found_here)), [len(h) for h, _ in found_here]), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*[piece.column(c).take(take) for c in kept],
                     pa.array(np.concatenate([h for h, _ in found_here]).view(np.int64)),
                     pa.array(np.concatenate([p for _, p in found_here]), pa.int32())], names=[*kept, "v", "p"])

    emitted = written(emit.mapInArrow(
        batch, f"h1 long, h2 long, none boolean, doc_id {id_type}, line_no int, v long, p int"), "line-variants")
    place = F.struct("none", "doc_id", "line_no")
    # substitution: the earliest line of a variant at the same place
    cut = emitted.where("p >= 0")
    hubs = cut.groupBy("v", "p").agg(F.min(F.struct(place.alias("at"), "h1", "h2")).alias("hub"),
                                     F.min("h1").alias("a"), F.max("h1").alias("b")).where("a != b")
    same = cut.join(hubs.select("v", "p", "hub"), ["v", "p"]).select("h1", "h2", "hub.h1", "hub.h2").toDF(
        "h1", "h2", "e1", "e2").where("h1 != e1 or h2 != e2")
    # deletion: a whole line and the lines that lose a character to it; the later one is dropped
    whole = emitted.where("p < 0").select("v", place.alias("w_at"), F.col("h1").alias("w1"), F.col("h2").alias("w2"))
    met = cut.select("v", place.alias("at"), "h1", "h2").distinct().join(whole, "v")
    later = F.col("w_at") < F.col("at")
    one_less = met.select(F.when(later, F.col("h1")).otherwise(F.col("w1")).alias("h1"),
                          F.when(later, F.col("h2")).otherwise(F.col("w2")).alias("h2"),
                          F.when(later, F.col("w1")).otherwise(F.col("h1")).alias("e1"),
                          F.when(later, F.col("w2")).otherwise(F.col("h2")).alias("e2"))
    links = same.union(one_less).distinct()
    a = texts.select("h1", "h2", F.col("line").cast("string").alias("line"))
    b = texts.select(F.col("h1").alias("e1"), F.col("h2").alias("e2"), F.col("line").cast("string").alias("earlier"))
    return links.join(a, ["h1", "h2"]).join(b, ["e1", "e2"]).where(
        F.levenshtein("line", "earlier", 1) >= 0).select("h1", "h2", "e1", "e2")


def _marked_lines(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(lines of every row, the same with a word only and the marks ``exact`` and ``near``)."""
    every = line_table(docs, id_col, text_col, _line_keys, [("keys", "array<bigint>", pa.list_(pa.int64()))], "lines",
                       empty_rows=True)
    lines = every.where("line_no >= 0")
    distinct = written(first_places(lines.select("doc_id", "row", "line_no", "h1", "h2"), by_row=True), "line-first")
    near = near_links(docs, lines, distinct, id_col, text_col).select("h1", "h2").distinct().withColumn("near", F.lit(True))
    marks = written(distinct.select("h1", "h2", F.col("row").alias("first_row"), F.col("line_no").alias("first_no"))
                    .join(near, ["h1", "h2"], "left").fillna(False, ["near"]), "line-marks")
    return every, lines.select("doc_id", "row", "line_no", "h1", "h2").join(marks, ["h1", "h2"]).select(
        "doc_id", "row", "line_no", ((F.col("row") != F.col("first_row")) | (F.col("line_no") != F.col("first_no")))
        .alias("exact"), "near")


def line_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every line with a word: doc_id, row (number of the input row), line_no, ``exact`` (the same line is
    earlier), ``near`` (a line within one edit of it is earlier)."""
    return _marked_lines(docs, id_col, text_col)[1]


def row_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_lines (with a word), n_exact, n_near, ``dropped`` (line numbers, in order)."""
    every, marked = _marked_lines(docs, id_col, text_col)
    gone = F.col("exact") | F.col("near")
    without = every.where("line_no < 0").select(
        "doc_id", "row", "line_no", F.lit(False).alias("exact"), F.lit(False).alias("near"))
    return marked.union(without).groupBy(F.col("row").alias("__row")).agg(
        F.first("doc_id").alias(id_col), F.count_if(F.col("line_no") >= 0).alias("n_lines"),
        F.count_if("exact").alias("n_exact"), F.count_if(F.col("near") & ~F.col("exact")).alias("n_near"),
        F.sort_array(F.collect_list(F.when(gone, F.col("line_no")))).alias("dropped")).drop("__row")


def document_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`row_decisions` with one row per id: counts are summed over the rows of an id, and a line number is
    dropped when every row of the id drops it, so no row loses a line of its own."""
    rows = row_decisions(docs, id_col, text_col)
    return rows.groupBy(id_col).agg(
        F.sum("n_lines").alias("n_lines"), F.sum("n_exact").alias("n_exact"), F.sum("n_near").alias("n_near"),
        F.collect_list("dropped").alias("dropped")).withColumn("dropped", F.sort_array(F.aggregate(
            "dropped", F.get("dropped", F.lit(0)), F.array_intersect)))


def drop_lines(text: F.Column, dropped: F.Column) -> F.Column:
    """A document's text without its dropped lines."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains(dropped, i)), "\n")
