"""Structured Streaming log monitoring.

Each function maps a streaming frame of raw lines (``value``) to the streaming
frame a query writes, using the *same* parsing and aggregation functions as
the batch path (``tessera.plans.logs``), so batch and stream results agree.

State notes for scale:
* windowed aggregates with a watermark drop state for windows older than the
  watermark in append/update mode; complete mode keeps all state by design;
* the unwindowed per-host reports (W6, W7) keep one state row per host: state
  grows with the number of distinct hosts, not with the input volume.  The
  ``windowed_host_bytes`` variant bounds it by time instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.logs import block_fields
from tessera.functions.temporal import to_ntz
from tessera.plans import logs as L


@dataclass(frozen=True)
class StreamSpec:
    """A streaming frame plus how to write it: output mode and result keys."""

    frame: DataFrame
    mode: str
    keys: tuple = ()
    order: tuple = ()


def parse_stream(lines: DataFrame, watermark: str | None = None) -> DataFrame:
    """Parsed lines, optionally with an event-time watermark on ``event_ts``."""
    p = L.parsed(lines)
    return p.withWatermark("event_ts", watermark) if watermark else p


def parsed_append(lines: DataFrame, watermark: str | None = None) -> StreamSpec:
    """W1/W3 + K5: stateless parse, append mode.  ``event_ts`` is written as TIMESTAMP_NTZ."""
    p = parse_stream(lines, watermark)
    return StreamSpec(p.select("value", to_ntz("event_ts").alias("event_ts"), "component", "log_level", "message"),
                      "append")


def tumbling_counts(lines: DataFrame, duration: str = "10 seconds", watermark: str | None = "5 seconds",
                    mode: str = "complete") -> StreamSpec:
    """Count per (tumbling window, component, level)."""
    p = parse_stream(lines, watermark)
    c = L.window_counts(p, "event_ts", duration, None, ["component", "log_level"], "event_count")
    return StreamSpec(c, mode, ("window_start", "window_end", "component", "log_level"))


def sliding_datanode_counts(lines: DataFrame, duration: str = "60 seconds", slide: str = "30 seconds",
                            watermark: str | None = "5 seconds", mode: str = "update") -> StreamSpec:
    """DataNode lines per sliding window; update (default) or append mode.

    In append mode a window is written once, after the watermark passes its end.
    """
    p = L.datanode_lines(parse_stream(lines, watermark))
    c = L.window_counts(p, "event_ts", duration, slide, (), "datanode_count")
    return StreamSpec(c, mode, ("window_start", "window_end"))


def host_bytes(lines: DataFrame) -> StreamSpec:
    """W6 + Z7: running total bytes per host, sorted, complete mode."""
    return StreamSpec(L.host_bytes(lines), "complete", ("hostname",), (F.col("total_bytes").desc_nulls_last(), F.col("hostname").asc_nulls_first()))


def windowed_host_bytes(lines: DataFrame, duration: str = "1 hour", watermark: str = "5 seconds") -> StreamSpec:
    """W6 with bounded state: bytes per host per event-time window, append mode."""
    p = block_fields(parse_stream(lines, watermark))
    c = (p.groupBy(F.window("event_ts", duration).alias("window"), "hostname")
         .agg(F.sum("block_size").alias("total_bytes")))
    return StreamSpec(c.select(to_ntz("window.start").alias("window_start"), to_ntz("window.end").alias("window_end"),
                               "hostname", "total_bytes"), "append")


def host_block_operations(lines: DataFrame) -> StreamSpec:
    """W7 + Z7: INFO block operations per host, sorted, complete mode."""
    return StreamSpec(L.host_block_operations(lines), "complete", ("hostname",), (F.desc("block_operations"), F.asc("hostname")))


def level_window_counts(lines: DataFrame, level: str = "ERROR", duration: str = "1 hour",
                        watermark: str | None = "5 seconds") -> StreamSpec:
    """W12 input: lines of one level per tumbling window (complete mode).

    The above-mean flag is applied to the snapshot (see ``busy_windows``).
    """
    p = parse_stream(lines, watermark).filter(F.col("log_level") == level)
    c = L.window_counts(p, "event_ts", duration, None, (), "event_count")
    return StreamSpec(c, "complete", ("window_start", "window_end"))


def keyed_running_sum(stream: DataFrame, key: str, value: str, name: str = "total") -> StreamSpec:
    """W6 (generic): running sum of ``value`` per ``key``, largest first, complete mode."""
    agg = stream.groupBy(key).agg(F.sum(value).alias(name)).orderBy(F.col(name).desc_nulls_last(), key)
    return StreamSpec(agg, "complete", (key,), (F.col(name).desc_nulls_last(), F.asc(key)))


def keyed_running_count(stream: DataFrame, key: str, condition, name: str = "count") -> StreamSpec:
    """W7 (generic): running count of rows matching ``condition`` per ``key``, complete mode."""
    cond = F.expr(condition) if isinstance(condition, str) else condition
    agg = stream.filter(cond).groupBy(key).agg(F.count(F.lit(1)).alias(name)).orderBy(F.col(name).desc(), key)
    return StreamSpec(agg, "complete", (key,), (F.desc(name), F.asc(key)))


def window_counts_stream(stream: DataFrame, ts: str, duration: str, watermark: str | None = "5 seconds",
                         mode: str = "complete", name: str = "event_count") -> StreamSpec:
    """W4/W12 (generic): rows per tumbling event-time window of a TIMESTAMP column."""
    s = stream.withWatermark(ts, watermark) if watermark else stream
    c = L.window_counts(s, ts, duration, None, (), name)
    return StreamSpec(c, mode, ("window_start", "window_end"))
