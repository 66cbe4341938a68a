"""Column expressions that type the raw text of a feed.

All of them are built-in Spark expressions, so they run inside whole-stage
code generation; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from starling.schema import MONEY

# The accepted text layouts.
# yyyy-MM-dd HH:mm:ss with an optional fraction; month, day and hour may drop
# the leading zero.  A bare date does not match.
TIMESTAMP_PATTERN = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?$"
# Characters removed from money text before it is read as a number.
MONEY_NOISE = r"[$,]"


def _text(c) -> Column:
    return F.trim(F.col(c) if isinstance(c, str) else c)


def strict_int(c, dtype: T.DataType = T.IntegerType()) -> Column:
    """Whole-number text only: ``'12'`` and ``'+12'`` pass, ``'1.5'``, ``'1e3'``,
    ``'x'``, empty text and out-of-range values give NULL (the row is
    quarantined).  ``try_cast`` follows the ANSI rules whatever the session's
    ANSI setting, and they accept only an optionally signed run of digits."""
    return _text(c).try_cast(dtype)


def strict_long(c) -> Column:
    return strict_int(c, T.LongType())


def strict_timestamp(c) -> Column:
    """``yyyy-MM-dd HH:mm:ss[.f]`` to ``timestamp_ntz``; a bare date, bad text
    or an impossible date give NULL."""
    t = _text(c)
    return F.when(t.rlike(TIMESTAMP_PATTERN), t.try_cast(T.TimestampNTZType()))


def _money_digits(c) -> Column:
    return F.regexp_replace(_text(c), MONEY_NOISE, "")


def money(c) -> Column:
    """Tolerant money cast: strip ``$`` and ``,``; text that is not a number
    (or does not fit ``decimal(10,2)``) becomes 0.00."""
    return F.coalesce(_money_digits(c).try_cast(MONEY), F.lit(0).cast(MONEY))


def money_is_defaulted(c) -> Column:
    """True where :func:`money` fell back to 0.00, so the row can be reported."""
    return _money_digits(c).try_cast(MONEY).isNull()
