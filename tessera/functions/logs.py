"""HDFS log-line field extraction (X23) shared by batch and streaming frames.

Lines look like ``yyMMdd HHmmss pid LEVEL component: message``.  ``regexp_extract``
returns ``''`` on no match; by default we turn that into NULL (``nullif``) so
``isNotNull`` filters really reject failed extractions.  ``keep_unmatched=True``
keeps the empty strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.numeric import as_col
from tessera.functions.temporal import LOG_TS_FORMAT, parse_timestamp

# Extraction patterns, group 1 of each is the field.
DATE_PATTERN = r"^(\d{6})"
TIME_PATTERN = r"^\d{6}\s(\d{6})"
COMPONENT_PATTERN = r"(\w+):"
LEVEL_PATTERN = r"(\bINFO\b|\bWARN\b|\bERROR\b)"
MESSAGE_PATTERN = r":\s(.*)"
SOURCE_PATTERN = r"(/[\d\.]+:\d+)"
SIZE_PATTERN = r"size\s+(\d+)"
BLOCK_PATTERN = r"(blk_[-\d]+)"
IPV4_PATTERN = r"(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})"
HOST_FROM_SOURCE_PATTERN = r"/([\d\.]+)"
# Full logger name (``dfs.DataNode$PacketResponder``); the short pattern above
# stops at ``$`` and ``.`` and so yields ``PacketResponder``.
FULL_COMPONENT_PATTERN = r"^\d{6}\s\d{6}\s\d+\s\w+\s([^\s:]+):"


def extract(c, pattern: str, keep_unmatched: bool = False) -> Column:
    """First capture group of ``pattern``; NULL when it does not match."""
    got = F.regexp_extract(as_col(c), pattern, 1)
    return got if keep_unmatched else F.nullif(got, F.lit(""))


def event_time(c) -> Column:
    """Date and time groups joined by a space, parsed as ``yyMMdd HHmmss``."""
    c = as_col(c)
    stamp = F.concat_ws(" ", F.regexp_extract(c, DATE_PATTERN, 1), F.regexp_extract(c, TIME_PATTERN, 1))
    return parse_timestamp(stamp, LOG_TS_FORMAT)


def parse_log_lines(df: DataFrame, value_col: str = "value", keep_unmatched: bool = False,
                    component_pattern: str = COMPONENT_PATTERN) -> DataFrame:
    """Add ``event_ts, component, log_level, message`` to a frame of raw lines.

    Any ingest timestamp column is left untouched (it is *not* overwritten by
    the event time).  Works on batch and streaming frames alike.
    """
    v = F.col(value_col)
    return df.withColumns({
        "event_ts": event_time(v),
        "component": extract(v, component_pattern, keep_unmatched),
        "log_level": extract(v, LEVEL_PATTERN, keep_unmatched),
        "message": extract(v, MESSAGE_PATTERN, keep_unmatched),
    })


def block_fields(df: DataFrame, value_col: str = "value", keep_unmatched: bool = False) -> DataFrame:
    """Add ``source, block_size, hostname, block_id, ip`` used by the host reports.

    ``hostname`` comes from ``/ip:port`` only (lines with ``size N from /ip`` have
    no port, so their bytes belong to the NULL host -- reference behaviour).
    ``block_size`` is ``try_cast`` to long.
    """
    v = F.col(value_col)
    source = extract(v, SOURCE_PATTERN, keep_unmatched)
    return df.withColumns({
        "source": source,
        "block_size": F.regexp_extract(v, SIZE_PATTERN, 1).try_cast("long"),
        "hostname": extract(F.coalesce(source, F.lit("")), HOST_FROM_SOURCE_PATTERN, keep_unmatched),
        "block_id": extract(v, BLOCK_PATTERN, keep_unmatched),
        "ip": extract(v, IPV4_PATTERN, keep_unmatched),
    })
