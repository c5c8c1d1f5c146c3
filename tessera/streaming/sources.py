"""Streaming sources.

File sources (text, csv, json, parquet, orc) take a path and, but for text, a declared
schema.  Sources without a path (``socket``, ``rate``, ``kafka``) are configured by their
options.  The operators need a ``value`` line column; Kafka's binary ``value`` is cast to text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructType

from tessera.session import ensure_utc

# A file is read by one task: this many rows keep the cores of a cluster busy on a small batch.
ROWS_PER_FILE = 100_000
# A large batch has larger files rather than more of them than a shuffle has partitions, up to this many rows.
MOST_ROWS_PER_FILE = 1_000_000


def line_stream(spark: SparkSession, path: str | None = None, fmt: str = "text", include_ingest_ts: bool = True,
                max_files_per_trigger: int | None = None, schema: StructType | str | None = None, **options) -> DataFrame:
    """A stream of raw lines as ``value`` (+ ``ingest_ts`` = processing time), or of a declared schema's columns."""
    ensure_utc(spark)
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.load(path) if path is not None else reader.load()
    if "value" in df.columns and isinstance(df.schema["value"].dataType, BinaryType):
        df = df.withColumn("value", F.col("value").cast("string"))
    return df.withColumn("ingest_ts", F.current_timestamp()) if include_ingest_ts else df


def table_stream(spark: SparkSession, folder: str, table: str, schema: StructType | None = None,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A parquet table (``<folder>/<table>.parquet``, one file or a folder of part files) read as a stream.

    The path is written as a glob, which the file source resolves to the file itself or to
    the folder's files; the schema is taken from the table unless given.
    """
    ensure_utc(spark)
    path = f"{folder.rstrip('/')}/{table}.parquet"
    if schema is None:
        schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def replay(spark: SparkSession, rows: DataFrame, members: Sequence[Column], out: str, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """``rows`` as a stream with one micro-batch for each condition of ``members``, in that order.

    Each batch is one folder, written after the one before it, so the file source takes them in
    order.  All batches have the same number of part files, as the largest needs, and a trigger
    takes that many.
    """
    ensure_utc(spark)
    sizes = rows.agg(*(F.count(F.when(m, 1)).alias(f"n{i}") for i, m in enumerate(members))).first()
    filled = [m for i, m in enumerate(members) if sizes[i]]
    return _write_batches(spark, rows, filled, _part_files(spark, max(sizes), rows_per_file), out)


def _part_files(spark: SparkSession, rows: int, rows_per_file: int) -> int:
    """Part files for a batch of ``rows``."""
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // MOST_ROWS_PER_FILE)
    return max(1, min(rows // rows_per_file, most))


def _write_batches(spark: SparkSession, rows: DataFrame, members: Sequence[Column], files: int, out: str) -> DataFrame:
    for i, m in enumerate(members or [F.lit(True)]):
        folder = f"{out}/batch={i:05d}"
        rows.filter(m).repartition(files).write.mode("overwrite").parquet(folder)
        # A task without rows leaves no file, but a trigger counts files: empty ones keep the batches apart.
        for _ in range(files - len(spark.read.schema(rows.schema).parquet(folder).inputFiles())):
            rows.limit(0).write.mode("append").parquet(folder)
    return (spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).option("basePath", out)
            .parquet(f"{out}/batch=*").select(*rows.columns))


def replay_in_time_order(spark: SparkSession, rows: DataFrame, ts: str, out: str, batches: int = 4, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """``rows`` as a stream of ``batches`` micro-batches in event-time order: no row is late.

    One pass finds the cuts and the number of rows.  Rows without a time belong to the first batch.
    """
    ensure_utc(spark)
    seconds = F.unix_micros(F.col(ts).cast("timestamp"))
    shares = F.array(*(F.lit(i / batches) for i in range(1, batches))) if batches > 1 else F.array(F.lit(0.0))
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(seconds, shares, 10_000).alias("cuts")).first()
    cuts = sorted(set(found.cuts or [])) if batches > 1 else []
    # On the column itself, so that a scan can skip row groups.
    edges = [F.timestamp_micros(F.lit(c)).cast(rows.schema[ts].dataType) for c in cuts]
    if not edges:
        return _write_batches(spark, rows, [], _part_files(spark, found.n, rows_per_file), out)
    inner = [(F.col(ts) >= a) & (F.col(ts) < b) for a, b in zip(edges, edges[1:])]
    members = [(F.col(ts) < edges[0]) | F.col(ts).isNull(), *inner, F.col(ts) >= edges[-1]]
    return _write_batches(spark, rows, members, _part_files(spark, found.n // batches, rows_per_file), out)
