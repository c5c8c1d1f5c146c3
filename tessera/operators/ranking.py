"""Sorts, top-k and explicit-order sorts.

``top_k`` is ``orderBy(...).limit(k)``, which Spark plans as
``TakeOrderedAndProject``: each task keeps its own k best rows and only k rows
per task reach the final merge -- never a full sort of the input.  A unique
tie-break key is always appended so results are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import position_in


def _order(spec) -> Column:
    """``"col"`` ascending, ``"-col"`` descending (NULLs last either way), or a Column."""
    if isinstance(spec, Column):
        return spec
    if spec.startswith("-"):
        return F.col(spec[1:]).desc_nulls_last()
    return F.col(spec).asc_nulls_last()


def sort(df: DataFrame, *specs) -> DataFrame:
    """Global sort (range-partitioned), multi-key, ``-`` prefix for descending.

    End the keys with a (near-)unique column: range boundaries are drawn from a
    sample of the full key, so a heavy leading value is spread over tasks only
    if later keys tell its rows apart.
    """
    return df.orderBy(*[_order(s) for s in specs])


def top_k(df: DataFrame, k: int, order: Sequence, tie_break: Sequence[str] = ()) -> DataFrame:
    """The k first rows by ``order`` then ``tie_break`` (ascending)."""
    specs = [_order(s) for s in order] + [_order(t) for t in tie_break]
    return df.orderBy(*specs).limit(k)


def sort_by_value_list(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Order rows by an explicit value list (absent values first, like the reference)."""
    return df.orderBy(position_in(col, values).asc_nulls_last(), F.col(col))
