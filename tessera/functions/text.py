"""String helpers: labels, tokens, substring predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.numeric import as_col


def join_label(cols: Sequence, sep: str = ", ") -> Column:
    """``concat_ws`` of the columns' text forms (NULLs skipped)."""
    return F.concat_ws(sep, *[as_col(c).cast("string") for c in cols])


def split_tokens(c, sep_regex: str) -> Column:
    """Split by a regular expression into an array."""
    return F.split(as_col(c), sep_regex)


def explode_tokens(c, sep_regex: str) -> Column:
    """One row per token; NULL input gives no row, duplicates are kept."""
    return F.explode(split_tokens(c, sep_regex))


def position_in(c, values: Sequence[str]) -> Column:
    """1-based position of ``c`` in a literal list; 0 when absent, NULL for NULL."""
    return F.array_position(F.array(*[F.lit(v) for v in values]), as_col(c))


def contains(c, needle: str) -> Column:
    """substring test."""
    return as_col(c).contains(needle)
