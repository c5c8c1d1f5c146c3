"""Streaming operators with keyed state of their own, chained windows, late rows and state inspection.

* ``host_baselines``: per-key anomaly flags against the key's *earlier* windows (W12);
* ``windows_of_windows``: an aggregate over the windows of another one (W4), in append mode;
* ``late_side``: rows that come too late for their window, kept beside the counts (W2);
* ``state_rows`` / ``state_operators``: what a query's checkpoint holds, read as a table (W6, W7, W10).

``transformWithState`` needs the RocksDB state store: start such queries inside ``rocksdb_state``.
"""

from __future__ import annotations

import contextlib
import math
from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructField, StructType

from tessera.functions.temporal import to_ntz
from tessera.session import scratch_path
from tessera.streaming.sinks import StreamRun, run_stream

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextlib.contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries that are started inside keep their state in RocksDB."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


# A window against the earlier windows of its key.

class Baseline(StatefulProcessor):
    """Running count, mean and squared deviations of a key's windows (Welford's update).

    A window is told with the figures of the windows before it, then joins them.  Windows of a
    key come in order: the window aggregate below emits each once, after the watermark has
    passed its end, and those of one batch are sorted here.  A key without a window for
    ``idle_seconds`` of event time is forgotten by a timer.
    """

    def __init__(self, key_names: Sequence[str], deviations: float, min_windows: int, idle_seconds: int):
        self.key_names, self.deviations, self.min_windows, self.idle_ms = list(key_names), deviations, min_windows, idle_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.past = handle.getValueState("past", "n bigint, mean double, m2 double, timer bigint")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        n, mean, m2, timer = self.past.get() if self.past.exists() else (0, 0.0, 0.0, None)
        names = dict(zip(self.key_names, key))
        end = 0
        for start, stop, count in sorted((r["start_us"], r["end_us"], r["event_count"]) for r in rows):
            spread = math.sqrt(m2 / (n - 1)) if n > 1 else None
            unusual = n >= self.min_windows and spread is not None and abs(count - mean) > self.deviations * spread
            yield Row(**names, start_us=start, end_us=stop, event_count=count, earlier_windows=n, mean_before=mean if n else None,
                      stddev_before=spread, unusual=unusual)
            n += 1
            delta = count - mean
            mean += delta / n
            m2 += delta * (count - mean)
            end = max(end, stop)
        if timer is not None:
            self.handle.deleteTimer(timer)
        timer = end // 1000 + self.idle_ms
        self.handle.registerTimer(timer)
        self.past.update((n, mean, m2, timer))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        self.past.clear()
        return iter(())

    def close(self) -> None:
        pass


def host_baselines(parsed: DataFrame, keys: Sequence[str], ts: str = "event_ts", duration: str = "1 hour", deviations: float = 2.0,
                   min_windows: int = 3, idle_seconds: int = 90 * 86400) -> DataFrame:
    """One row per (window, key), once the watermark of ``parsed`` has passed the window: its count against the
    mean and standard deviation of the key's earlier windows; ``unusual`` if it is more than ``deviations`` of
    them away and at least ``min_windows`` came before.

    Bounded state: a window's count until it closes, then four numbers per key that was seen in the
    last ``idle_seconds`` of event time.  NULL keys are keys like others.
    """
    counts = (parsed.groupBy(F.window(ts, duration).alias("window"), *keys).agg(F.count(F.lit(1)).alias("event_count"))
              .select(*keys, F.unix_micros("window.start").alias("start_us"), F.unix_micros("window.end").alias("end_us"), "event_count",
                      F.window_time("window").alias("window_time")))  # carries the watermark on
    fields = [StructField(k, counts.schema[k].dataType) for k in keys]
    out = StructType(fields).add("start_us", "long").add("end_us", "long").add("event_count", "long").add("earlier_windows", "long") \
        .add("mean_before", "double").add("stddev_before", "double").add("unusual", "boolean")
    told = counts.groupBy(*keys).transformWithState(Baseline(keys, deviations, min_windows, idle_seconds), out, "append", "eventTime")
    return told.select(to_ntz(F.timestamp_micros("start_us")).alias("window_start"), to_ntz(F.timestamp_micros("end_us")).alias("window_end"),
                       *keys, "event_count", "earlier_windows", "mean_before", "stddev_before", "unusual")


# Windows over windows.

def windows_of_windows(parsed: DataFrame, keys: Sequence[str], ts: str = "event_ts", inner: str = "10 seconds", outer: str = "1 hour") -> DataFrame:
    """Per ``outer`` window and key: events, the fullest ``inner`` window and how many had events.

    Two chained aggregates in append mode: the inner windows' own time carries the watermark on,
    so both keep state only for windows that are still open.
    """
    small = parsed.groupBy(F.window(ts, inner).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    large = (small.groupBy(F.window(F.window_time("w"), outer).alias("window"), *keys)
             .agg(F.sum("n").alias("event_count"), F.max("n").alias("max_inner_count"), F.count(F.lit(1)).alias("inner_windows")))
    return large.select(to_ntz("window.start").alias("window_start"), to_ntz("window.end").alias("window_end"), *keys,
                        "event_count", "max_inner_count", "inner_windows")


# Late rows.

def late_side(stream: DataFrame, ts: str, duration: str, delay: str, name: str) -> tuple[StreamRun, DataFrame]:
    """Windowed counts of ``stream`` and, beside them, the rows that came after their window was closed.

    Returns the counts' run (update mode) and the late rows: every row with a time is in one of the two.  The
    counts are a watermarked aggregate, which drops late rows.  The late query reads the same
    source in the same batches and holds each batch's rows against the watermark that the first
    query's late filter has in that batch.  Newest times are kept per batch beside the output, so a batch
    that is run again after a failure finds the same ones and rewrites the same folder.
    """
    counted = (stream.withWatermark(ts, delay).groupBy(F.window(ts, duration).alias("window")).agg(F.count(F.lit(1)).alias("event_count"))
               .select(to_ntz("window.start").alias("window_start"), to_ntz("window.end").alias("window_end"), "event_count"))
    counts = run_stream(counted, "update", f"{name}_counts", ("window_start", "window_end"))

    spark, out = stream.sparkSession, scratch_path(stream.sparkSession, f"{name}_late")

    def split(batch: DataFrame, batch_id: int) -> None:
        times = f"{out}/newest"
        batch = batch.persist()
        try:
            (batch.agg(F.max(ts).cast("timestamp").alias("newest")).withColumn("batch", F.lit(batch_id).cast("long"))
             .coalesce(1).write.mode("overwrite").parquet(f"{times}/number={batch_id}"))
            # The watermark moves after a batch, and the late filter follows one batch behind the closing of windows.
            seen = (batch.sparkSession.read.schema("newest timestamp, batch long").parquet(times)
                    .filter(F.col("batch") < batch_id - 1).agg(F.max("newest")).scalar())
            late = F.window(ts, duration)["end"] <= seen - F.expr(f"INTERVAL {delay}")
            batch.filter(F.col(ts).isNotNull()).filter(F.coalesce(late, F.lit(False))).write.mode("overwrite").parquet(f"{out}/data/number={batch_id}")
        finally:
            batch.unpersist()

    query = (stream.writeStream.foreachBatch(split).option("checkpointLocation", f"{out}/_checkpoint")
             .trigger(availableNow=True).start())
    StreamRun(spark, out, "append", query=query).wait()
    return counts, spark.read.schema(stream.schema).parquet(f"{out}/data").select(*stream.columns)


def dropped_rows(run: StreamRun) -> int:
    """Rows that the query's state operators dropped as late (after partial aggregation), over all its batches."""
    return sum(int(op["numRowsDroppedByWatermark"]) for p in run.progress for op in p["stateOperators"] or ())


# What a checkpoint holds.

def state_rows(spark: SparkSession, run_path: str, operator: int = 0, batch_id: int | None = None) -> DataFrame:
    """The state of one operator of a query, read from its checkpoint: ``key`` and ``value`` structs.

    As of the newest finished batch, or of ``batch_id``; the query may be stopped or running.
    """
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(f"{run_path}/_checkpoint").select("key", "value", "partition_id")


def state_operators(spark: SparkSession, run_path: str) -> DataFrame:
    """The stateful operators of a query, with the batches that their state covers."""
    return spark.read.format("state-metadata").load(f"{run_path}/_checkpoint")


def running_sums(spark: SparkSession, run: StreamRun, key: str, name: str, batch_id: int | None = None) -> DataFrame:
    """A keyed running sum out of its query's state, without its sink."""
    state = state_rows(spark, run.path, batch_id=batch_id)
    value: Column = F.col("value")[state.schema["value"].dataType.names[0]]
    return state.select(F.col("key")[state.schema["key"].dataType.names[0]].alias(key), value.alias(name))


__all__ = ["ROCKSDB", "rocksdb_state", "Baseline", "host_baselines", "windows_of_windows", "late_side", "dropped_rows",
           "state_rows", "state_operators", "running_sums"]
