"""Exact decimal arithmetic with the warehouse database's rules.

Money sums are ``decimal``.  A decimal division keeps six decimals, rounded
half up, the rule of the original warehouse database; Spark gives the same
``decimal(38,6)`` when both operands are ``decimal(38,2)``.  Division by zero
or by NULL is NULL (ANSI Spark would raise instead).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from starling.schema import MONEY_SUM, RATIO


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_sum(c) -> Column:
    return F.sum(_c(c)).cast(MONEY_SUM)


def ratio(num, den) -> Column:
    """``num / den`` as decimal(38,6), NULL when ``den`` is NULL or 0."""
    n, d = _c(num).cast(MONEY_SUM), _c(den).cast(MONEY_SUM)
    return F.when(d.isNull() | (d == 0), F.lit(None).cast(RATIO)).otherwise(n / d)


def change_pct(current, previous) -> Column:
    """``(current - previous) / previous * 100``, six-decimal ratio."""
    cur, prev = _c(current), _c(previous)
    return (ratio(cur - prev, prev) * 100).cast(RATIO)


def change_pct_rounded(current, previous, digits: int = 2) -> Column:
    return F.round(change_pct(current, previous), digits).cast(MONEY_SUM)
