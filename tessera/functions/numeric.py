"""Numeric helpers: safe casts, rounding, division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def try_cast(c, dtype: str) -> Column:
    """Cast; bad input -> NULL (ANSI-safe).  double->int truncates toward zero."""
    return as_col(c).try_cast(dtype)


def round_half_up(c, digits: int = 0) -> Column:
    """HALF_UP rounding on the decimal value (round(-87.65, 1) = -87.7)."""
    return F.round(as_col(c), digits)


def safe_div(num, den) -> Column:
    """Division that yields NULL on a zero divisor instead of raising."""
    return F.try_divide(as_col(num), as_col(den))


def no_negative_zero(c) -> Column:
    """Map -0.0 to 0.0 so grouping keys and outputs print one zero."""
    c = as_col(c)
    return F.when(c == 0, F.lit(0.0)).otherwise(c)


def seconds_to_minutes(c) -> Column:
    """X26."""
    return as_col(c) / F.lit(60.0)
