"""HDFS log analytics on batch frames (W1, W3-W7, W12-W14 without the stream).

The functions take a frame with a raw ``value`` line column and work
unchanged on streaming frames (see ``tessera.streaming.logs``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.logs import (BLOCK_PATTERN, COMPONENT_PATTERN, IPV4_PATTERN, LEVEL_PATTERN, block_fields, extract,
                                    parse_log_lines)
from tessera.functions.temporal import to_ntz
from tessera.operators.aggregates import compare_with_global


def parsed(lines: DataFrame, component_pattern: str = COMPONENT_PATTERN) -> DataFrame:
    """``value`` plus ``event_ts, component, log_level, message`` (NULL when unmatched)."""
    return parse_log_lines(lines, "value", component_pattern=component_pattern)


def unparsed_lines(parsed_lines: DataFrame) -> DataFrame:
    """Reject side: lines whose event time could not be parsed.

    Event-time windows drop such rows silently (NULL time); this keeps them
    visible for inspection.
    """
    return parsed_lines.filter(F.col("event_ts").isNull())


def datanode_lines(parsed_lines: DataFrame, needle: str = "DataNode") -> DataFrame:
    """F6/W5 input: lines whose component contains ``needle``."""
    return parsed_lines.filter(F.col("component").contains(needle))


def keep_levels_components(parsed_lines: DataFrame, levels: Sequence[str] | None = None,
                           components: Sequence[str] | None = None) -> DataFrame:
    """Keep given log levels and/or components."""
    out = parsed_lines
    if levels:
        out = out.filter(F.col("log_level").isin(list(levels)))
    if components:
        out = out.filter(F.col("component").isin(list(components)))
    return out


def window_counts(df: DataFrame, ts: str, duration: str, slide: str | None = None, keys: Sequence[str] = (),
                  count_name: str = "count") -> DataFrame:
    """Rows per event-time window (tumbling, or sliding with ``slide``) and keys.

    The window struct is flattened to ``window_start`` / ``window_end``
    (TIMESTAMP_NTZ, wall clock in UTC).  Rows with NULL time fall out.
    """
    w = F.window(ts, duration, slide) if slide else F.window(ts, duration)
    counts = df.groupBy(w.alias("window"), *keys).agg(F.count(F.lit(1)).alias(count_name))
    return counts.select(to_ntz("window.start").alias("window_start"), to_ntz("window.end").alias("window_end"),
                         *keys, count_name)


def host_bytes(lines: DataFrame, keep_unmatched: bool = False) -> DataFrame:
    """Total block bytes per host (host from ``/ip:port``), largest first, NULL totals last.

    ``keep_unmatched=True`` reports lines without a host under ``''`` as the
    reference did; the default groups them under NULL.
    """
    fields = block_fields(lines, keep_unmatched=keep_unmatched).select("hostname", "block_size")
    return (fields.groupBy("hostname").agg(F.sum("block_size").alias("total_bytes"))
            .orderBy(F.col("total_bytes").desc_nulls_last(), F.col("hostname").asc_nulls_first()))


def block_lines(lines: DataFrame, level: str = "INFO") -> DataFrame:
    """``value, log_level, block_id, hostname`` of the lines of one level that name a block and an address.

    Plain substring tests come first: they are cheap, drop most other lines and leave less for
    the patterns, each of which is then matched once.
    """
    likely = lines.filter(F.col("value").contains(level) & F.col("value").contains("blk_") & F.col("value").contains("."))
    found = likely.select("value", F.struct(extract("value", LEVEL_PATTERN).alias("log_level"), extract("value", BLOCK_PATTERN).alias("block_id"),
                                            extract("value", IPV4_PATTERN).alias("hostname")).alias("f"))
    # Generated rows keep the three patterns from being matched again for the filter.
    found = found.select("value", F.explode(F.array("f")).alias("f")).select("value", "f.*")
    return found.filter((F.col("log_level") == level) & F.col("block_id").isNotNull() & F.col("hostname").isNotNull())


def host_block_operations(lines: DataFrame, level: str = "INFO", keep_unmatched: bool = False) -> DataFrame:
    """INFO lines that name a block and an IPv4 address, counted per address.

    With ``keep_unmatched=True`` failed extractions stay ``''`` and pass the
    not-NULL tests, reproducing the reference's blank-host row.
    """
    if keep_unmatched:
        p = parse_log_lines(lines, keep_unmatched=True).select("value", "log_level")
        f = block_fields(p, keep_unmatched=True).filter((F.col("log_level") == level) & F.col("block_id").isNotNull()
                                   & F.col("ip").isNotNull()).withColumn("hostname", F.col("ip"))
    else:
        f = block_lines(lines, level)
    return (f.groupBy("hostname").agg(F.count(F.lit(1)).alias("block_operations"))
            .orderBy(F.col("block_operations").desc(), "hostname"))


def host_component_counts(lines: DataFrame) -> DataFrame:
    """Lines per (host address, component, level)."""
    p = block_fields(parse_log_lines(lines))
    return p.groupBy(F.col("ip").alias("hostname"), "component", "log_level").agg(
        F.count(F.lit(1)).alias("event_count"))


def busy_windows(counts: DataFrame, count_col: str = "count") -> DataFrame:
    """Windows whose count is above the mean window count (anomaly flag)."""
    return compare_with_global(counts, count_col, "avg", ">", stat_name="mean_count")
