"""Sorted results that keep their order when they are written.

A table has no order of its own; files read by many tasks come back in any.  ``write_ordered``
deals rows to files by range, sorts each file and numbers the rows through: every row gets a
gapless ``ordinal``.  ``read_ordered`` gives them back in that order, and any page of it by the
ordinal alone, without sorting by the keys again.  No task sees more than its range; the rows
before a file are a sum over one number per file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ORDINAL = "ordinal"
_PART, _PLACE = "__part", "__place"


def write_ordered(df: DataFrame, path: str, order: Sequence[str | Column], files: int | None = None) -> str:
    """Write ``df`` sorted by ``order``: files by range, sorted inside, with each row's place in its file.

    Finer keys at the end of ``order`` split runs of equal values over several files.
    """
    dealt = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    placed = (dealt.sortWithinPartitions(*order).withColumn(_PART, F.spark_partition_id())
              .withColumn(_PLACE, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    placed.write.mode("overwrite").parquet(path)
    return path


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """The written rows with their ``ordinal``, from 0 without gaps."""
    rows = spark.read.parquet(path)
    sizes = rows.groupBy(_PART).agg(F.count(F.lit(1)).alias("n"))
    # One row per file: the window works on the files, not on their rows.
    before = sizes.select(_PART, F.coalesce(F.sum("n").over(Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    return rows.join(before, _PART).withColumn(ORDINAL, F.col("__before") + F.col(_PLACE)).drop(_PART, _PLACE, "__before")


def read_ordered(spark: SparkSession, path: str, first: int | None = None, rows: int | None = None) -> DataFrame:
    """The rows in their written order; ``first`` and ``rows`` cut out a page."""
    out = numbered(spark, path)
    if first is not None:
        out = out.filter(F.col(ORDINAL) >= first)
    if rows is not None:
        out = out.filter(F.col(ORDINAL) < (first or 0) + rows)
    return out.orderBy(ORDINAL)


def neighbours(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Each row's keys beside those of the row after it (``next_<key>``): an equality of ordinals."""
    rows = numbered(spark, path).select(ORDINAL, *keys)
    after = rows.select((F.col(ORDINAL) - 1).alias(ORDINAL), *(F.col(k).alias(f"next_{k}") for k in keys))
    return rows.join(after, ORDINAL)


__all__ = ["ORDINAL", "write_ordered", "numbered", "read_ordered", "neighbours"]
