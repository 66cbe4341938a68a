"""Mixture-controlled packing: deficit round-robin over source queues.

Each source is a queue of the token ids of its documents.  A window (sequence)
is filled with quanta of ``quantum`` ids.  In every round a source is credited
in proportion to its target weight and sends a quantum when its credit covers
one; what it could not send stays as its deficit and counts in the next round,
in the next window and across partitions.  A source that runs out leaves its
share to the others by weight.  With the default weights (the sources' own
token counts) every window holds the sources' proportions to within a quantum
each, and all queues end together.

Nothing is simulated one window after the other: quantum k of a source with
weight w is due at (k + 1) / w rounds, so its place among all quanta is a sum of
one count per source (:func:`quantum_positions`, exact integers).  Every task
computes the places of its own documents' quanta from the queue offsets of its
partition and one row per source; deficits at a partition's start are thus
known without the partitions before it.

At scale: one pass tokenizes and writes the ids once, with the running count
per source in the partition; queue offsets come from a sum per (partition,
source); a second, narrow pass cuts the pieces.  Texts are never shuffled and
no source is gathered.  The source table has at most ``MAX_SOURCES`` rows
(enforced) and is the only thing sent to the tasks.  Padding: only the last
sequence can be short.

Defined cases: a null or empty text is the end id alone; a null source is a
queue of its own; repeated rows are documents of their own; a text longer than
a window is cut as often as needed; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from starling.llm.common import bounded_broadcast, small_table, text_or_empty, written

WINDOW, QUANTUM, END_ID = 2048, 128, 1
MAX_SOURCES = 10_000
STEP = 1024  # rows a task works on at a time
CACHE_WORDS = 600_000
_SCHEMA_PIECES = ("doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, "
                  "sequence_id long, offset long")


class WordCache:
    """Token ids of texts, with the ids of space-separated pieces kept.

    The tokenizer never merges across white space, so the ids of a text are
    those of its pieces one after the other.  A Latin-1 text is lower-cased here
    (it has nothing to compose, and lower-casing it twice changes nothing), and
    a mark between a letter and white space is set apart, where the tokenizer
    cuts anyway; so most pieces are plain words, shared by many texts.  New
    words are encoded many at a time and cut apart at the ids that end a word;
    other pieces are encoded one by one.  The tokenizer finds its special tokens
    before it lower-cases, so a text that holds one in any case is a single
    piece, as it stands.  The cache starts anew when it is full.
    """

    MARK = "([a-z\xdf-\xf6\xf8-\xff])([.,;:!?])([ \\n]|$)"

    def __init__(self, path: str, limit: int = CACHE_WORDS):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.limit = limit
        self.ids: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for token, i in vocabulary.items():
            self.ends[i] = token.endswith("</w>")
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = "(?i)" + "|".join(map(re.escape, added)) if added else None

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in
                self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _add(self, new: list[str]) -> None:
        words, other = [], []
        for p in new:
            (words if p.isalpha() else other).append(p)
        for at in range(0, len(words), 2_000):
            part = words[at:at + 2_000]
            ids, = self._encode([" ".join(part)])
            stops = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(stops) == len(part):
                data = ids.tobytes()
                self.ids.update(zip(part, [data[4 * a:4 * b] for a, b in zip([0, *stops], stops)]))
            else:  # something that is not one word to the tokenizer
                other += part
        for at in range(0, len(other), 2_000):
            part = other[at:at + 2_000]
            self.ids.update(zip(part, [x.tobytes() for x in self._encode(part)]))

    def _pieces(self, texts: pa.Array) -> pa.ListArray:
        latin = pc.invert(pc.match_substring_regex(texts, "[^\\x00-\xff]"))
        lowered = pc.replace_substring_regex(pc.utf8_lower(texts), self.MARK, r"\1 \2\3")
        ready = pc.replace_substring(pc.if_else(latin, lowered, texts), "\n", " ")
        whole = pc.match_substring_regex(texts, self.special) if self.special else None
        if whole is None or not pc.any(whole).as_py():
            return pc.split_pattern(ready, " ")
        split = pc.split_pattern(pc.if_else(whole, "", ready), " ")  # one empty piece, replaced by the text
        offsets = np.asarray(split.offsets) - split.offsets[0].as_py()
        mask = np.zeros(offsets[-1], dtype=bool)
        mask[offsets[:-1][np.asarray(whole)]] = True
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pc.replace_with_mask(
            split.flatten(), pa.array(mask), texts.filter(whole)))

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of all texts one after the other, each with the
        end id behind, and where each text begins."""
        split = self._pieces(texts)
        bounds = np.asarray(split.offsets) - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        wanted = coded.dictionary.to_pylist()
        new = [p for p in wanted if p not in self.ids]
        if len(self.ids) + len(new) > self.limit:
            self.ids.clear()
            new = wanted
        if new:
            self._add(new)
        found = [*map(self.ids.__getitem__, wanted), np.array([end_id], dtype="<u4").tobytes()]
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        start = np.cumsum(size) - size
        pool = np.frombuffer(b"".join(found), dtype="<u4")
        codes = np.insert(coded.indices.to_numpy(zero_copy_only=False), bounds[1:], len(found) - 1)
        sizes = size[codes]
        ends = np.cumsum(sizes)
        ids = pool[np.repeat(start[codes] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.concatenate(([0], ends[bounds[1:] + np.arange(len(texts))])).astype(np.int64)


_CACHES: dict[str, WordCache] = {}


def worker_cache(path: str) -> WordCache:
    """The cache of this Python worker, kept from one task to the next."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core
    if path not in _CACHES:
        _CACHES[path] = WordCache(path)
    return _CACHES[path]


def token_table(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", end_id: int = END_ID) -> DataFrame:
    """Written once: doc_id, source, part, place (ids of the source before it in the part), n, ids."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       text_or_empty(text_col).alias("text"))

    def run(batches):
        cache, before = worker_cache(tokenizer), {}
        part = TaskContext.get().partitionId()
        for b in batches:
            for at in range(0, b.num_rows, STEP):  # bounded memory whatever the batch size
                piece = b.slice(at, STEP)
                ids, offsets = cache.encode(piece.column("text"), end_id)
                n = np.diff(offsets)
                place = []
                for s, k in zip(piece.column("source").to_pylist(), n.tolist()):
                    place.append(before.get(s, 0))
                    before[s] = place[-1] + k
                binary = pa.Array.from_buffers(pa.large_binary(), len(n), [
                    None, pa.py_buffer(offsets * 4), pa.py_buffer(np.ascontiguousarray(ids))]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("source"), pa.array([part] * len(n), pa.int32()),
                     pa.array(place, pa.int64()), pa.array(n, pa.int64()), binary],
                    names=["doc_id", "source", "part", "place", "n", "ids"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return written(rows.mapInArrow(
        run, f"doc_id {id_type}, source string, part int, place long, n long, ids binary"), "pack-ids")


def quantum_positions(source: int, k: np.ndarray, units: list[int], weights: list[int], last: list[int],
                      quantum: int) -> np.ndarray:
    """Global token position of quanta ``k`` of a source.

    Quantum j of source s is due at (j + 1) / weights[s]; those due earlier, or
    at the same time in an earlier source, come before it.  ``units`` counts the
    quanta of a source, of which the last has ``last`` tokens.
    """
    big = (max(units) + 1) * max(weights) >= 1 << 62
    due = (k + 1).astype(object if big else np.int64)
    position = np.zeros(len(k), dtype=due.dtype)
    for s, (n, w, tail) in enumerate(zip(units, weights, last)):
        if s == source:
            before = due - 1
        else:  # j + 1 < due * w / weights[source], or equal in an earlier source
            before = (due * w - (0 if s < source else 1)) // weights[source]
        before = np.minimum(before, n)
        position = position + before * quantum - np.where(before == n, quantum - tail, 0)
    return position.astype(np.int64)


def cut_document(offset: int, n: int, quantum_at: np.ndarray, first: int, quantum: int, window: int):
    """Cut a document at ``offset`` of its queue, of ``n`` ids: arrays (start, length, position)."""
    k = np.arange(offset // quantum, (offset + n - 1) // quantum + 1)
    start = np.maximum(k * quantum, offset)
    stop = np.minimum((k + 1) * quantum, offset + n)
    position = quantum_at[k - first] + (start - k * quantum)
    # a quantum after a short last one of another source may cross a window
    room = window - position % window
    length = stop - start
    over = length > room
    if over.any():
        start = np.concatenate((start, start[over] + room[over]))
        position = np.concatenate((position, position[over] + room[over]))
        length = np.concatenate((np.minimum(length, room), length[over] - room[over]))
        order = np.argsort(start, kind="stable")
        start, position, length = start[order], position[order], length[order]
    # quanta that follow each other in the same window are one piece
    new = np.ones(len(start), dtype=bool)
    new[1:] = (position[1:] != position[:-1] + length[:-1]) | (position[1:] // window != position[:-1] // window)
    at = np.flatnonzero(new)
    return start[at] - offset, np.add.reduceat(length, at), position[at]


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         window: int = WINDOW, quantum: int = QUANTUM, weights: dict[str | None, int] | None = None,
         end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer`` is the path of a ``tokenizers`` file that every task can read.
    ``weights`` (positive integers per source) sets target proportions; the
    default is the sources' own sizes.
    """
    ids = token_table(docs, tokenizer, id_col, text_col, source_col, end_id)
    held = written(ids.groupBy("source", "part").agg(F.sum("n").alias("n")), "pack-counts")
    totals = small_table(held.groupBy("source").agg(F.sum("n").alias("n")), MAX_SOURCES, "sources")
    totals.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    number = {r["source"]: i for i, r in enumerate(totals)}
    size = [int(r["n"]) for r in totals]
    units = [-(-n // quantum) for n in size]
    last = [n - (u - 1) * quantum for n, u in zip(size, units)]
    share = units if weights is None else [int(weights[r["source"]]) for r in totals]

    # rows of a source are one per part, however many documents it has
    order = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("source", "part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("queue_start"))
    s = starts.select(F.col("source").alias("s"), F.col("part").alias("p"), "queue_start")
    rows = ids.join(bounded_broadcast(written(s, "pack-starts")), F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p"))).select(
        "doc_id", "source", (F.col("queue_start") + F.col("place")).alias("at"), "n", "ids")
    id_type = docs.schema[id_col].dataType.simpleString()

    def places(sources: list, ats: list, sizes: list) -> list[tuple[int, np.ndarray]]:
        """Per document: its first quantum and the positions of its quanta (all of a source at once)."""
        out: list = [None] * len(sources)
        rows_of: dict = {}
        for i, src in enumerate(sources):
            rows_of.setdefault(src, []).append(i)
        for src, rows_i in rows_of.items():
            spans = [np.arange(ats[i] // quantum, (ats[i] + sizes[i] - 1) // quantum + 1) for i in rows_i]
            at = quantum_positions(number[src], np.concatenate(spans), units, share, last, quantum)
            for i, span, where in zip(rows_i, spans, np.split(at, np.cumsum([len(x) for x in spans])[:-1])):
                out[i] = (int(span[0]), where)
        return out

    def cut(b: pa.RecordBatch):
        ids_of, docs_of = b.column("ids"), b.column("doc_id")
        ats, sizes = b.column("at").to_pylist(), b.column("n").to_pylist()
        out: list[list] = [[] for _ in range(6)]
        index: list[int] = []
        for i, (first, where) in enumerate(places(b.column("source").to_pylist(), ats, sizes)):
            start, length, position = cut_document(ats[i], sizes[i], where, first, quantum, window)
            data = memoryview(ids_of[i].as_buffer())
            a, c = start.tolist(), length.tolist()
            out[0] += a
            out[1] += c
            out[2] += [zlib.crc32(data[4 * x:4 * (x + y)]) for x, y in zip(a, c)]
            out[3] += [sizes[i]] * len(a)
            out[4] += (position // window).tolist()
            out[5] += (position % window).tolist()
            index += [i] * len(a)
        yield pa.RecordBatch.from_arrays(
            [docs_of.take(pa.array(index, pa.int64()))] + [pa.array(x, pa.int64()) for x in out],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, STEP):
                yield from cut(b.slice(at, STEP))

    return rows.mapInArrow(run, _SCHEMA_PIECES.format(id=id_type))
