"""Lines of documents as narrow rows, and the texts of chosen lines.

Used by the line and paragraph operators: both first work on hashes of all
lines, then need the texts of the few that may have a partner.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from starling.llm.common import bounded_broadcast, text_or_empty, written

#: Rows a task holds at a time, whatever the size of a record batch.
STEP = 256


def line_hash(line: bytes) -> tuple[int, int]:
    """128-bit hash of a line as two signed longs."""
    h = xxhash.xxh3_128_intdigest(line)
    lo, hi = h & (1 << 64) - 1, h >> 64
    return lo - (1 << 64) if lo >> 63 else lo, hi - (1 << 64) if hi >> 63 else hi


def text_lines(text: bytes) -> list[tuple[int, bytes]]:
    """(number, line without white space at its ends) of every line with a word; numbers count all lines."""
    return [(i, s) for i, x in enumerate(text.split(b"\n")) if (s := x.strip())]


def line_table(docs: DataFrame, id_col: str, text_col: str, extra: Callable[[list[bytes]], list[list]],
               extra_schema: list[tuple[str, str, pa.DataType]], purpose: str, empty_rows: bool = False) -> DataFrame:
    """Written once: doc_id, row, line_no, h1, h2 and the ``extra`` columns of every line with a word.

    ``row`` numbers the input rows, so lines of rows without an id, or with the same one, stay apart.
    ``extra`` maps a list of lines to one list of values per extra column.  With ``empty_rows`` an input row
    without such a line has one with line number -1.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        row = TaskContext.get().partitionId() << 33
        for b in batches:
            for at in range(0, b.num_rows, STEP):
                piece = b.slice(at, STEP)
                index, number, found = [], [], []
                for i, text in enumerate(piece.column("text").cast(pa.binary())):
                    for no, line in text_lines(text.as_py()) or ([(-1, b"")] if empty_rows else []):
                        index.append(i)
                        number.append(no)
                        found.append(line)
                hashes = [line_hash(x) for x in found]
                more = extra(found)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id").take(pa.array(index, pa.int64())),
                     pa.array([row + i for i in index], pa.int64()), pa.array(number, pa.int32()),
                     pa.array([a for a, _ in hashes], pa.int64()), pa.array([b for _, b in hashes], pa.int64()),
                     *[pa.array(v, t) for v, (_, _, t) in zip(more, extra_schema)]],
                    names=["doc_id", "row", "line_no", "h1", "h2", *[n for n, _, _ in extra_schema]])
                row += piece.num_rows

    schema = f"doc_id {id_type}, row long, line_no int, h1 long, h2 long"
    for name, kind, _ in extra_schema:
        schema += f", {name} {kind}"
    return written(rows.mapInArrow(run, schema), purpose)


def first_places(lines: DataFrame, by_row: bool = False) -> DataFrame:
    """One row per distinct line: h1, h2, its first place (``doc_id``, ``line_no``; null ids last), ``copies``.

    ``by_row`` tells places of rows without an id, or with the same one, apart and adds the place's ``row``.

    Map-side minima: a line that a third of all documents hold is reduced before the shuffle.
    """
    more = ["row"] if by_row else []
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "line_no", *more))
    return lines.groupBy("h1", "h2").agg(
        first.alias("f"), F.count(F.lit(1)).alias("copies")).select(
        "h1", "h2", F.col("f.doc_id").alias("doc_id"), F.col("f.line_no").alias("line_no"),
        *[F.col(f"f.{c}").alias(c) for c in more], "copies")


def line_texts(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, purpose: str) -> DataFrame:
    """Written once: h1, h2, ``line`` (binary) of the ``wanted`` lines (h1, h2, doc_id, line_no).

    The documents that hold a wanted line are read again; a line is taken when its hash agrees.
    """
    places = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("line_no", "h1", "h2")).alias("places"))
    places = bounded_broadcast(written(places.withColumnRenamed("doc_id", "at_id"), f"{purpose}-places"))
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).join(
        places, F.col("doc_id").eqNullSafe(F.col("at_id"))).select("text", "places")

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, STEP):
                piece = b.slice(at, STEP)
                out: list[list] = [[], [], []]
                for text, places_of in zip(piece.column("text").cast(pa.binary()), piece.column("places").to_pylist()):
                    found = dict(text_lines(text.as_py()))
                    for p in places_of:
                        line = found.get(p["line_no"])
                        if line is not None and line_hash(line) == (p["h1"], p["h2"]):
                            out[0].append(p["h1"])
                            out[1].append(p["h2"])
                            out[2].append(line)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())],
                    names=["h1", "h2", "line"])

    texts = rows.mapInArrow(run, "h1 long, h2 long, line binary")
    return written(texts.dropDuplicates(["h1", "h2"]), purpose)
