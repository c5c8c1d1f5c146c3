"""Parquet table access for the driver's test tables (and any parquet dataset).

Reads are lazy; Catalyst prunes columns and pushes filters into the parquet
scan (``ReadSchema`` / ``PushedFilters`` in ``explain``), so callers should just
select what they need downstream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.session import ensure_utc

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table as a DataFrame (session pinned to UTC first)."""
    ensure_utc(spark)
    return spark.read.parquet(table_path(sf_dir, name))


class Tables:
    """Attribute access to the tables of one scale-factor folder: ``t.lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = ensure_utc(spark)
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)
