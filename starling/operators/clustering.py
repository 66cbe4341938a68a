"""The fact clustered by several columns at once.

Sorted by date, a fact lets a date filter skip files, and a filter on a store or a
product reads all of them.  Here the range key is the columns' positions with
their bits interleaved (a Z-order curve): every file covers a narrow range of each
column, so a filter on any of them skips files and row groups by their
statistics.

A column's position is the number of its quantiles (``2 ** bits - 1`` of them, from
one aggregate over all rows) that are not above the value: gaps, as between the
months of a ``yyyyMMdd`` key, and hot values take no positions from the others.
The range partitioner samples the interleaved key, so files stay even; ``tie``
splits the rows of one position, such as a hot store, over several files.  The
last column has the highest bits and skips best.

Defined cases: NULL has position 0; a column with one value has one position; an
empty table stays empty.  Rows are the same ones, in another order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

BITS = 6
ACCURACY = 2_000   # of the quantiles: a rank is off by at most a 2,000th of the rows
_Z, _AT = "__z", "__at_"


def interleaved(positions: Sequence[Column], bits: int) -> Column:
    """The bits of the positions (0 to ``2 ** bits - 1``), one of each column in turn, as one long."""
    if bits * len(positions) > 62:
        raise ValueError("the interleaved key has at most 62 bits")
    z = F.lit(0).cast("long")
    for i in range(bits):
        for j, p in enumerate(positions):
            bit = F.shiftright(p, i).bitwiseAND(F.lit(1).cast("long"))
            z = z.bitwiseOR(F.shiftleft(bit, i * len(positions) + j))
    return z


def cluster(rows: DataFrame, columns: Sequence[str], tie: str, files: int | None = None, bits: int = BITS) -> DataFrame:
    """``rows`` range-partitioned by the interleaved positions of numeric ``columns``, sorted inside a partition."""
    parts = F.array(*[F.lit(i / (1 << bits)) for i in range(1, 1 << bits)])
    splits = rows.agg(*[F.percentile_approx(c, parts, ACCURACY).alias(f"{_AT}{i}") for i, c in enumerate(columns)]).first()

    def position(i: int, c: str) -> Column:
        place = F.lit(0).cast("long")
        for split in splits[f"{_AT}{i}"] or []:
            place = place + (F.col(c) >= F.lit(split)).cast("long")
        return F.coalesce(place, F.lit(0).cast("long"))

    at = [f"{_AT}{i}" for i in range(len(columns))]
    keyed = rows.withColumns({a: position(i, c) for i, (a, c) in enumerate(zip(at, columns))})
    keyed = keyed.withColumn(_Z, interleaved([F.col(a) for a in at], bits)).drop(*at)
    by = [F.col(_Z), F.col(tie)]
    spread = keyed.repartitionByRange(*by) if files is None else keyed.repartitionByRange(files, *by)
    return spread.sortWithinPartitions(*by).drop(_Z)
