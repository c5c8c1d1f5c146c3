"""CASE-style labelling and fixed-width bins.

A rule is ``(low, high, label)`` with both ends inclusive; ``None`` leaves an end
open.  Rules are tried in order, the first match wins, anything else (including
NULL input) gets ``default``.  Everything compiles to one ``CASE WHEN`` chain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.numeric import as_col

Rule = tuple[float | None, float | None, str]

# Time-of-day bands on the hour 0-23 (inclusive ends).
TIME_OF_DAY_RULES: list[Rule] = [
    (5, 11, "Morning"),
    (12, 16, "Afternoon"),
    (17, 21, "Evening"),
]
TIME_OF_DAY_DEFAULT = "Night"

# Rating categories on a 0.5-5.0 star scale (inclusive ends).
RATING_RULES: list[Rule] = [
    (0.5, 2.5, "Low"),
    (3.0, 4.5, "Medium"),
    (5.0, 5.0, "High"),
]
RATING_DEFAULT = "Unknown"

# Half-year label on the month number.
HALF_YEAR_RULES: list[Rule] = [(1, 6, "Early Year")]
HALF_YEAR_DEFAULT = "Late Year"

# User activity labels.
FREQUENT_LABEL = "Frequent Rater"
INFREQUENT_LABEL = "Infrequent Rater"


def bucket_label(c, rules: Sequence[Rule], default: str) -> Column:
    """Label ``c`` by the first inclusive range it falls in."""
    c = as_col(c)
    expr = None
    for low, high, label in rules:
        cond = F.lit(True)
        if low is not None:
            cond = cond & (c >= F.lit(low))
        if high is not None:
            cond = cond & (c <= F.lit(high))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def time_of_day(hour) -> Column:
    """X15."""
    return bucket_label(hour, TIME_OF_DAY_RULES, TIME_OF_DAY_DEFAULT)


def rating_category(rating) -> Column:
    """Gaps (2.5, 3.0) and (4.5, 5.0) and NULL fall to Unknown."""
    return bucket_label(rating, RATING_RULES, RATING_DEFAULT)


def half_year(month) -> Column:
    """NULL month -> Late Year, as in the reference."""
    return bucket_label(month, HALF_YEAR_RULES, HALF_YEAR_DEFAULT)


def activity_class(n, threshold: int = 50) -> Column:
    """Strictly more than ``threshold`` -> frequent."""
    return F.when(as_col(n) > F.lit(threshold), F.lit(FREQUENT_LABEL)).otherwise(F.lit(INFREQUENT_LABEL))


def indicator(c) -> Column:
    """1 when not NULL, else 0."""
    return F.when(as_col(c).isNotNull(), F.lit(1)).otherwise(F.lit(0))


def fixed_width_bin(c, width: float, low: float, high: float) -> Column:
    """Left-closed bin start ``low + floor((c-low)/width)*width`` for ``low <= c < high``.

    Values outside ``[low, high)`` and NULL map to NULL (like ``pd.cut(right=False)``).
    """
    c = as_col(c)
    start = F.lit(low) + F.floor((c - F.lit(low)) / F.lit(width)) * F.lit(width)
    return F.when((c >= F.lit(low)) & (c < F.lit(high)), start.cast("double"))
