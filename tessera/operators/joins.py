"""Joins (J1, J2).

Strategy is left to Catalyst + AQE: a dimension whose *measured* size is under
``spark.sql.autoBroadcastJoinThreshold`` is broadcast (statically from file
statistics, or at run time by AQE from the real shuffle size); anything larger
gets a sort-merge join on the key, with AQE splitting skewed partitions.  We do
not hint ``broadcast`` on data-dependent sides, whose size is not proven.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich_endpoints(edges: DataFrame, vertices: DataFrame, id_col: str = "id",
                     src: str = "src", dst: str = "dst", attrs: Sequence[str] | None = None,
                     how: str = "left") -> DataFrame:
    """Attach vertex attributes to both ends of every edge.

    The vertex frame is joined twice in two roles with ``src_``/``dst_`` prefixed
    columns; ``left`` keeps edges whose endpoint is missing.
    """
    attrs = list(attrs) if attrs is not None else [c for c in vertices.columns if c != id_col]
    s = vertices.select(F.col(id_col).alias("__sid"), *[F.col(a).alias(f"src_{a}") for a in attrs])
    d = vertices.select(F.col(id_col).alias("__did"), *[F.col(a).alias(f"dst_{a}") for a in attrs])
    out = edges.join(s, edges[src] == s["__sid"], how).drop("__sid")
    return out.join(d, out[dst] == d["__did"], how).drop("__did")


def semi_join(df: DataFrame, keys_df: DataFrame, on, anti: bool = False) -> DataFrame:
    """EXISTS / NOT EXISTS filter by another frame's keys (F3 for long allow-lists, G11)."""
    return df.join(keys_df, on=on, how="left_anti" if anti else "left_semi")
