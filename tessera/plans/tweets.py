"""Geo / time-of-day analytics (composites C1-C8) as reusable DataFrame functions.

Inputs are column names, so the same functions run on tweets
(``longitude, latitude, timestamp, timezone``) or on any stand-in table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.buckets import time_of_day
from tessera.functions.numeric import no_negative_zero, round_half_up, try_cast
from tessera.functions.temporal import (TWEET_TS_FORMAT, WEEKDAY_ORDER, WEEKEND, date_text,
                                        datetime_text, hour_of_day, parse_timestamp,
                                        shift_hours, weekday_name)
from tessera.functions.text import join_label, position_in
from tessera.operators.aggregates import compare_with_global, group_count
from tessera.operators.clean import keep_in
from tessera.operators.ranking import top_k


def utc_calendar(df: DataFrame, ts_text: str = "timestamp", tz: str = "timezone",
                 pattern: str = TWEET_TS_FORMAT) -> DataFrame:
    """Parse local wall time, drop rows without a zone, shift to UTC, derive calendar text.

    Adds ``utc_ts`` (TIMESTAMP), ``utc_timestamp`` (``yyyy-MM-dd HH:mm:ss`` text),
    ``date`` (``yyyy-MM-dd``) and ``day_of_week``; ``tz`` becomes an int.  A row
    whose time fails to parse is kept (with NULL time), as in the reference.
    """
    out = df.withColumn(tz, try_cast(tz, "int")).filter(F.col(tz).isNotNull())
    out = out.withColumn("utc_ts", shift_hours(parse_timestamp(ts_text, pattern), F.col(tz)))
    return out.withColumns({
        "utc_timestamp": datetime_text("utc_ts"),
        "date": date_text("utc_ts"),
        "day_of_week": weekday_name("utc_ts"),
    })


def weekday_rows(cal: DataFrame, day_col: str = "day_of_week",
                 order_cols: tuple[str, ...] = ("date", "utc_ts")) -> DataFrame:
    """Weekday rows only (NULL day dropped), in date order.

    The sort continues on finer keys (time, then e.g. a row id) so the range
    partitioner can split one heavy date over many tasks instead of sorting
    all of that date's rows in one.
    """
    return keep_in(cal, day_col, WEEKEND, negate=True).orderBy(*[F.col(c).asc_nulls_last() for c in order_cols])


def grid_cells(df: DataFrame, lon: str, lat: str, precision: int = 1,
               lon_name: str = "lon_rounded", lat_name: str = "lat_rounded") -> DataFrame:
    """Add rounded grid coordinates (HALF_UP; -0.0 folded into 0.0)."""
    return df.withColumns({
        lon_name: no_negative_zero(round_half_up(try_cast(lon, "double"), precision)),
        lat_name: no_negative_zero(round_half_up(try_cast(lat, "double"), precision)),
    })


def grid_density(df: DataFrame, lon: str, lat: str, precision: int = 1,
                 count_name: str = "tweet_count") -> DataFrame:
    """Rows per rounded (lon, lat) cell."""
    return group_count(grid_cells(df, lon, lat, precision), ["lon_rounded", "lat_rounded"], count_name)


def density_by_cell_and_hour(df: DataFrame, lon: str, lat: str | None, ts: str, precision: int = 1,
                             count_name: str = "count") -> DataFrame:
    """Rows per grid cell and hour of day (``lat=None`` for a one-axis grid)."""
    cells = df.withColumns({
        "lon_rounded": no_negative_zero(round_half_up(try_cast(lon, "double"), precision)),
        "hour": hour_of_day(ts),
    })
    keys = ["lon_rounded", "hour"]
    if lat is not None:
        cells = cells.withColumn("lat_rounded", no_negative_zero(round_half_up(try_cast(lat, "double"), precision)))
        keys = ["lon_rounded", "lat_rounded", "hour"]
    return group_count(cells, keys, count_name)


def time_of_day_distribution(df: DataFrame, ts: str, count_name: str = "count") -> DataFrame:
    """C4: rows per time-of-day band, most frequent first."""
    labelled = df.withColumn("time_of_day", time_of_day(hour_of_day(ts)))
    return group_count(labelled, "time_of_day", count_name).orderBy(F.col(count_name).desc(), "time_of_day")


def weekday_volume(df: DataFrame, day_col: str = "day_of_week", total_name: str = "total_tweets",
                   k_name: str = "tweets_k", order_name: str = "day_order") -> DataFrame:
    """Rows per weekday name, thousands (truncated), calendar position, calendar order."""
    counts = group_count(df, day_col, total_name)
    return (counts.withColumns({
        k_name: (F.col(total_name) / F.lit(1000)).cast("int"),
        order_name: position_in(day_col, WEEKDAY_ORDER),
    }).orderBy(order_name))


def above_mean(counts: DataFrame, value_col: str) -> DataFrame:
    """Groups whose count is above the mean count of all groups."""
    return compare_with_global(counts, value_col, "avg", ">")


def top_cells(grid: DataFrame, k: int = 10, count_col: str = "tweet_count",
              label_name: str = "location", count_name: str = "num_tweets") -> DataFrame:
    """The k densest cells with a ``"lon, lat"`` label (ties: lon, lat ascending)."""
    best = top_k(grid, k, [f"-{count_col}"], ["lon_rounded", "lat_rounded"])
    return best.select(join_label(["lon_rounded", "lat_rounded"]).alias(label_name),
                       F.col(count_col).alias(count_name))
