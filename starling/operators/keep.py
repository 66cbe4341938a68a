"""Keyed reductions that pick one whole row per key.

Both use a hash aggregate of ``max``/``min`` over a struct whose leading
fields are the ordering.  The aggregate is partial on the map side, so a key
that holds a third of all rows is reduced inside every map task before the
shuffle and never lands whole in one task (a ``row_number`` window would put
all rows of the key into one sort).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

_PICK = "__picked"


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], agg) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*order, *rest)
    return (df.groupBy(*keys).agg(agg(packed).alias(_PICK))
            .select(*keys, *[F.col(f"{_PICK}.{c}").alias(c) for c in df.columns if c not in keys]))


def keep_last(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str]) -> DataFrame:
    """One row per key: the row that is greatest in ``order`` (then in the other columns)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return _pick(df, keys, order, F.max)


def keep_first(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str]) -> DataFrame:
    """One row per key: the row that is least in ``order`` (then in the other columns)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return _pick(df, keys, order, F.min)
