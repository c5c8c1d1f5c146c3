"""Calendar and clock expressions (all JVM-side, NULL-safe under ANSI mode).

Parsing uses ``try_to_timestamp`` so malformed text becomes NULL instead of
failing the job (Spark 4 runs with ANSI on; the reference's Spark 3 gave NULL).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.numeric import as_col

# Timestamp text formats used by the reference's inputs.
TWEET_TS_FORMAT = "yyyyMMddHHmmss"          # tweets: 20130112021500
TRIP_TS_FORMAT = "MM/dd/yyyy hh:mm:ss a"     # taxi trips: 01/31/2014 11:45:00 PM
LOG_TS_FORMAT = "yyMMdd HHmmss"              # HDFS logs: 081109 203615
DATE_TEXT_FORMAT = "yyyy-MM-dd"
DATETIME_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
WEEKDAY_FORMAT = "EEEE"

# Calendar order of weekday names.
WEEKDAY_ORDER = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
WEEKEND = ["Saturday", "Sunday"]


def parse_timestamp(c, pattern: str) -> Column:
    """Text -> TIMESTAMP by pattern; junk -> NULL."""
    return F.try_to_timestamp(as_col(c).cast("string"), F.lit(pattern))


def to_epoch_seconds(ts) -> Column:
    """Timestamp -> seconds since the epoch (UTC session)."""
    return F.unix_timestamp(as_col(ts))


def from_epoch_seconds(seconds) -> Column:
    """Seconds since the epoch -> TIMESTAMP (typed; no text round trip)."""
    return F.timestamp_seconds(as_col(seconds))


def epoch_to_date(seconds) -> Column:
    """X5 + cast: epoch seconds -> DATE."""
    return F.to_date(from_epoch_seconds(seconds))


def shift_hours(ts, hours) -> Column:
    """Local wall time -> UTC by subtracting a whole-hour zone offset.

    Same arithmetic as ``epoch - tz*3600``; NULL offset gives NULL.
    """
    return as_col(ts) - F.make_dt_interval(hours=as_col(hours).cast("int"))


def date_text(ts) -> Column:
    """``yyyy-MM-dd`` text (sorts chronologically)."""
    return F.date_format(as_col(ts), DATE_TEXT_FORMAT)


def datetime_text(ts) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text, the form ``from_unixtime`` returns."""
    return F.date_format(as_col(ts), DATETIME_TEXT_FORMAT)


def weekday_name(ts) -> Column:
    """Full English weekday name."""
    return F.date_format(as_col(ts), WEEKDAY_FORMAT)


def hour_of_day(ts) -> Column:
    """X9."""
    return F.hour(as_col(ts))


def year_of(ts) -> Column:
    """X10."""
    return F.year(as_col(ts))


def month_of(ts) -> Column:
    """X10."""
    return F.month(as_col(ts))


def to_ntz(ts) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ for outputs (wall-clock value, zone-free)."""
    return as_col(ts).cast("timestamp_ntz")
