"""Types of text columns, inferred in one pass, with the rows that do not fit kept aside.

Every column is tried against a lattice of types, narrow to wide; one aggregate over all rows
counts what each cast would lose, so no sample decides and nothing is read twice per column.
A column gets the narrowest type that at most ``max_bad_share`` of its values miss; with 0 the
type must fit all of them.  Rows with a value that misses its column's type go to a side table
with the names of the columns, so a few junk rows neither widen a type nor vanish as NULLs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Narrow to wide; text that has the form but does not fit (a number too large, 31 February) does not count.
LATTICE: dict[str, str] = {
    "int": r"^[+-]?\d{1,10}$",
    "bigint": r"^[+-]?\d{1,19}$",
    "double": r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$",
    "boolean": r"^(true|false)$",
    "date": r"^\d{4}-\d{2}-\d{2}$",
    "timestamp": r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?$",
}
BAD_COLUMNS = "_bad_columns"


def fits(value: Column, type_name: str) -> Column:
    """Whether a text has the form of a type and can be cast to it (text fits every form of text)."""
    if type_name == "string":
        return F.lit(True)
    return value.rlike(LATTICE[type_name]) & value.try_cast(type_name).isNotNull()


def infer_types(raw: DataFrame, max_bad_share: float = 0.0, columns: Sequence[str] | None = None) -> DataFrame:
    """``column_name, data_type, n_values, n_bad``: one row per column, in one aggregate over ``raw``.

    Empty text and NULL are no values; a column without values is text.
    """
    columns = list(columns or raw.columns)
    aggs = []
    for i, c in enumerate(columns):
        v = F.nullif(F.col(f"`{c}`"), F.lit(""))
        aggs.append(F.count(v).alias(f"n_{i}"))
        aggs += [F.count(F.when(v.isNotNull() & ~fits(v, t), 1)).alias(f"{t}_{i}") for t in LATTICE]
    told = []
    for i, c in enumerate(columns):
        n = F.col(f"n_{i}")
        kept = F.coalesce(*(F.when((n > 0) & (F.col(f"{t}_{i}") <= n * F.lit(max_bad_share)), F.struct(F.lit(t).alias("t"), F.col(f"{t}_{i}").alias("bad")))
                            for t in LATTICE), F.struct(F.lit("string").alias("t"), F.lit(0).cast("bigint").alias("bad")))
        told.append(F.struct(F.lit(c).alias("column_name"), kept["t"].alias("data_type"), n.alias("n_values"), kept["bad"].alias("n_bad")))
    return raw.agg(*aggs).select(F.explode(F.array(*told)).alias("c")).select("c.*")


def typed(raw: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """The rows whose values all fit, cast to their types."""
    return _marked(raw, types).filter(F.size(BAD_COLUMNS) == 0).select(
        *(F.nullif(F.col(f"`{c}`"), F.lit("")).try_cast(t).alias(c) if t != "string" else F.col(f"`{c}`") for c, t in types.items()))


def misfits(raw: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """The other rows as they were read, with the names of the columns that do not fit."""
    return _marked(raw, types).filter(F.size(BAD_COLUMNS) > 0)


def _marked(raw: DataFrame, types: Mapping[str, str]) -> DataFrame:
    values = {c: F.nullif(F.col(f"`{c}`"), F.lit("")) for c in types}
    bad = F.array_compact(F.array(*(F.when(values[c].isNotNull() & ~fits(values[c], t), F.lit(c)) for c, t in types.items())))
    return raw.withColumn(BAD_COLUMNS, bad)


def types_of(inferred: DataFrame) -> dict[str, str]:
    """The inferred types as a mapping: as many entries as there are columns."""
    return {r.column_name: r.data_type for r in inferred.collect()}


__all__ = ["LATTICE", "BAD_COLUMNS", "fits", "infer_types", "typed", "misfits", "types_of"]
