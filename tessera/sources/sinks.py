"""Batch sinks and actions (K1-K4).

Nothing here collects rows to the driver except ``preview`` (bounded by ``n``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> str:
    """K1: CSV with header.  ``single_file`` (``coalesce(1)``) only for small results:
    it funnels the whole write (and upstream narrow stages) through one task."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> str:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    writer.parquet(path)
    return path


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """K2: the first ``n`` rows as a DataFrame (``show`` stays with the caller)."""
    return df.limit(n)


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """K3: total row count as a lazy one-row frame."""
    return df.agg(F.count(F.lit(1)).alias(name))


def scalar_frame(df: DataFrame, expr, name: str = "value") -> DataFrame:
    """K4: a global aggregate kept as a one-row frame (join it, don't collect it)."""
    return df.agg(expr.alias(name))
