"""Calendar attributes of the time dimension and the OLAP queries."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Season names by month, in report order, and half-year labels.
SEASONS = [
    ("Spring", (3, 4, 5)),
    ("Summer", (6, 7, 8)),
    ("Fall", (9, 10, 11)),
    ("Winter", (12, 1, 2)),
]
HALVES = [("H1", 1, 6), ("H2", 7, 12)]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(d) -> Column:
    """Surrogate key of a date, ``yyyyMMdd`` as an int: stable across runs."""
    d = _c(d)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def day_name(d) -> Column:
    """Full English day name, e.g. ``Saturday``."""
    return F.date_format(_c(d), "EEEE")


def month_name(d) -> Column:
    """Full English month name, e.g. ``January``."""
    return F.date_format(_c(d), "MMMM")


def is_weekend(d) -> Column:
    """Day of week 1 (Sunday) or 7 (Saturday)."""
    return F.dayofweek(_c(d)).isin(1, 7)


def season(month) -> Column:
    m = _c(month)
    expr = None
    for name, months in SEASONS:
        expr = (F.when(m.isin(*months), F.lit(name)) if expr is None
                else expr.when(m.isin(*months), F.lit(name)))
    return expr


def season_rank(season_col) -> Column:
    s = _c(season_col)
    expr = None
    for rank, (name, _) in enumerate(SEASONS, start=1):
        expr = (F.when(s == name, F.lit(rank)) if expr is None
                else expr.when(s == name, F.lit(rank)))
    return expr


def half_year(month) -> Column:
    m = _c(month)
    (h1, lo1, hi1), (h2, lo2, hi2) = HALVES
    return F.when(m.between(lo1, hi1), F.lit(h1)).when(m.between(lo2, hi2), F.lit(h2))
