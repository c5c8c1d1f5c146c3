"""Projections, typed schemas and row filters.

Casting uses ``try_cast`` so a malformed field becomes NULL instead of failing
the whole job; ``split_rejects`` keeps the rows that failed as a side output.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.functions.numeric import as_col


def impose_schema(df: DataFrame, schema: StructType, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Select and ``try_cast`` source columns into a declared schema.

    ``mapping`` maps target field -> source column name (defaults to the same
    name, which may contain spaces).  A field with no source becomes NULL.
    """
    mapping = dict(mapping or {})
    cols = []
    for field in schema.fields:
        src = mapping.get(field.name, field.name)
        if src in df.columns:
            cols.append(F.col(f"`{src}`").try_cast(field.dataType).alias(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*cols)


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any (or the given) column."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def keep_in(df: DataFrame, col: str, values: Sequence, negate: bool = False) -> DataFrame:
    """``IN`` / ``NOT IN`` a literal list (an ``InSet`` for long lists).

    NOT IN keeps NULL-valued rows out, as SQL three-valued logic does.
    """
    cond = F.col(col).isin(list(values))
    return df.filter(~cond if negate else cond)


def not_blank(c) -> Column:
    """F1 for extracted text: not NULL and not the empty string."""
    c = as_col(c)
    return c.isNotNull() & (c != F.lit(""))


def split_rejects(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Return ``(good, rejected)``: rows with all ``required`` present vs the rest."""
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return df.filter(ok), df.filter(~ok)
