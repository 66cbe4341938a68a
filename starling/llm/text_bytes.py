"""Words of many texts at once, from their bytes: numpy work inside Arrow tasks.

A block is the UTF-8 bytes of many texts one after the other.  Bytes of 0x80
and above belong to code points outside ASCII, so a class of characters that
holds all of these, or none, is a class of bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Bytes of text a task works on at a time (a longer text is a block of its own).
BLOCK = 4 << 20
#: Size of a set of hashes that is sent to the tasks: 2^26 bits, 8 MB, whatever the input.
SET_BITS = 26

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # A-Z and nothing else


def byte_class(members: str | bytes | list[int], inverted: bool = False) -> np.ndarray:
    """A table of 256 flags; ``inverted`` flags all bytes but the members."""
    table = np.zeros(256, dtype=bool)
    table[[ord(c) if isinstance(c, str) else c for c in members]] = True
    return ~table if inverted else table


def blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """The batch in pieces of about ``limit`` bytes: (rows, their lower-cased bytes, where each text begins and the end)."""
    texts = batch.column(column).cast(pa.large_binary())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        to = min(to, len(texts))
        yield batch.slice(at, to - at), LOWER[data[offsets[at]:offsets[to]]], offsets[at:to + 1] - offsets[at]
        at = to


def spans(data: np.ndarray, bounds: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word: a longest run of ``word`` bytes inside a text."""
    flag = word[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    first, last = flag.copy(), flag.copy()
    first[1:] &= ~flag[:-1] | edge[1:-1]
    last[:-1] &= ~flag[1:] | edge[1:-1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(bounds, start, side="right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_RANDOM = np.random.default_rng(20)
_BYTE = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


_KEPT: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0, base ** 1 and so on; the worker keeps as many as its blocks have needed, of a usual block at most."""
    out = _KEPT.get(base)
    if out is None or len(out) < n:
        out = np.full(n if n > BLOCK else min(BLOCK, 1 << max(n - 1, 1).bit_length()), base, dtype=np.uint64)
        out[0] = 1
        out = np.multiply.accumulate(out)
        if n <= BLOCK:
            _KEPT[base] = out
    return out[:n]


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first ``n`` powers of the base of :func:`word_hashes`, or of its inverse."""
    return _powers(_INVERSE if inverse else _BASE, n)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span: a polynomial in its bytes, from running sums.

    Equal bytes give equal hashes; whoever needs exact answers compares the bytes too.
    """
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), out=total[1:])
    return mix((total[end] - total[start]) * _powers(_INVERSE, len(data) + 1)[start] + (end - start).astype(np.uint64))


def string_hashes(strings: pa.Array) -> np.ndarray:
    """:func:`word_hashes` of every string of an Arrow array without nulls."""
    flat = strings.cast(pa.large_binary())
    offsets = np.frombuffer(flat.buffers()[1], dtype=np.int64)[flat.offset:flat.offset + len(flat) + 1] if len(flat) else np.zeros(1, dtype=np.int64)
    data = np.frombuffer(flat.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    return word_hashes(data, offsets[:-1], offsets[1:])


def gather(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The spans as an Arrow string array."""
    size = end - start
    offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
    index = np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.Array.from_buffers(pa.large_string(), len(size), [
        None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[index]))]).cast(pa.string())


def gather_all(data: np.ndarray, start: np.ndarray, end: np.ndarray, word: np.ndarray) -> pa.Array:
    """:func:`gather` for all the spans that :func:`spans` gives: their bytes are the ``word`` bytes in order."""
    offsets = np.zeros(len(start) + 1, dtype=np.int32)
    np.cumsum(end - start, out=offsets[1:])
    return pa.Array.from_buffers(pa.string(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data[word[data]])])


def sums_by_key(key: np.ndarray, value: np.ndarray) -> pa.Table:
    """The distinct hashes ``h`` (as longs) and the sum ``c`` of the values of each."""
    t = pa.table([pa.array(key.view(np.int64)), pa.array(value)], names=["h", "c"])
    return t.group_by("h", use_threads=False).aggregate([("c", "sum")]).rename_columns(["h", "c"])


def hash_set(hashes: DataFrame, column: str, bits: int = SET_BITS) -> np.ndarray:
    """A set of hashes as 2^``bits`` bits, for :func:`held`; it may hold more than was put in, never less.

    The tasks merge the bits; at most 2^``bits`` / 64 rows come to the driver,
    whatever the number of hashes.
    """
    h: Column = F.col(column)
    cell = F.shiftrightunsigned(h, 6).bitwiseAND(F.lit((1 << bits - 6) - 1).cast("long"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))
    rows = hashes.groupBy(cell.alias("cell")).agg(F.bit_or(bit).alias("set")).toArrow()
    out = np.zeros(1 << bits - 6, dtype=np.uint64)
    out[rows.column("cell").to_numpy()] = rows.column("set").to_numpy().view(np.uint64)
    return out


def held(hashes: np.ndarray, members: np.ndarray) -> np.ndarray:
    """Which hashes are in a :func:`hash_set`."""
    cell = (hashes >> np.uint64(6)) & np.uint64(len(members) - 1)
    return (members[cell] >> (hashes & np.uint64(63))) & np.uint64(1) != 0
