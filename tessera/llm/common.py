"""Shared helpers of the training-data operators: document keys, folds, staged tables, Arrow batches."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

NULL_ID = -(1 << 63)


ROWS_PER_FILE = 1_000_000


def staged(spark: SparkSession, df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors.

    Where the caller knows that ``df`` has at most ``rows`` short rows, they go to a file per
    million instead of one per task.
    """
    path = scratch_path(spark, name)
    (df if rows is None else df.coalesce(1 + rows // ROWS_PER_FILE)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rest: Column | None = None) -> DataFrame:
    """``doc_id, k, x, text`` with NULL texts read as empty, and ``rest`` if given.

    ``(k, x)`` identifies a document where ids repeat or are NULL: ``k`` is the id
    (NULL as the smallest long) and ``x`` a hash of the text, so rows that repeat
    both id and text count as one document.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("k"),
                       F.xxhash64(text).alias("x"), text.alias("text"), *([] if rest is None else [rest.alias("rest")]))


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus`` (NULL ids hash the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of whole documents: a thousand rows of a few kilobytes, not Spark's ten thousand."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def hand_back() -> None:
    """Give memory that is no longer used back to the system: Python workers are kept for later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def by_bytes(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of the text column each, one row at least."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64))
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


__all__ = ["NULL_ID", "staged", "keyed_texts", "fold", "small_batches", "hand_back", "by_bytes"]
