"""Scalar functions on hand-made rows (FIXTURES.md sections 1-4)."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.functions import buckets, logs, temporal
from tessera.plans import tweets as T

TWEETS = [
    ("-87.65", "41.85", "20130112021500", "3"),
    ("-87.61", "41.88", "20130114110000", "0"),
    ("-87.64", "41.92", "20130114120000", "0"),
    ("-73.96", "40.75", "20130115170000", "0"),
    ("-73.96", "40.75", "20130115220000", "0"),
    ("-73.96", "40.75", "not-a-time", "1"),
    ("abc", "40.75", "20130115010101", "x"),
]
TWEET_COLS = "longitude string, latitude string, timestamp string, timezone string"


def test_utc_calendar_shift_and_filters(spark):
    df = spark.createDataFrame(TWEETS, TWEET_COLS)
    cal = T.utc_calendar(df).withColumn("tod", buckets.time_of_day(temporal.hour_of_day("utc_ts")))
    rows = {r["timestamp"]: r for r in cal.collect()}
    assert "20130115010101" not in rows              # zone 'x' -> NULL -> dropped
    first = rows["20130112021500"]
    assert first["utc_timestamp"] == "2013-01-11 23:15:00"
    assert first["day_of_week"] == "Friday" and first["tod"] == "Night"
    assert rows["20130114110000"]["tod"] == "Morning"
    assert rows["20130114120000"]["tod"] == "Afternoon"
    assert rows["20130115170000"]["tod"] == "Evening"
    assert rows["20130115220000"]["tod"] == "Night"
    assert rows["not-a-time"]["utc_ts"] is None       # kept, time NULL


def test_weekday_rows_drop_weekend_and_null(spark):
    df = spark.createDataFrame(TWEETS, TWEET_COLS)
    out = T.weekday_rows(T.utc_calendar(df)).collect()
    assert {r["day_of_week"] for r in out} == {"Friday", "Monday", "Tuesday"}
    assert [r["date"] for r in out] == sorted(r["date"] for r in out)


def test_round_half_up_and_grid(spark):
    df = spark.createDataFrame([("-87.65", "41.85"), ("-87.65", "41.85"), ("-0.04", "0.0")], "lon string, lat string")
    g = {(r["lon_rounded"], r["lat_rounded"]): r["tweet_count"] for r in T.grid_density(df, "lon", "lat", 1).collect()}
    assert g[(-87.7, 41.9)] == 2
    assert g[(0.0, 0.0)] == 1                         # -0.0 folded into 0.0


def test_rating_and_half_year_buckets(spark):
    vals = [0.5, 2.5, 2.7, 3.0, 4.5, 4.7, 5.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "r double")
    got = [r[0] for r in df.select(buckets.rating_category("r")).collect()]
    assert got == ["Low", "Low", "Unknown", "Medium", "Medium", "Unknown", "High", "Unknown"]
    ts = spark.createDataFrame([(1104537599,), (1104537600,)], "t long")
    out = ts.select(temporal.epoch_to_date("t").alias("d"),
                    buckets.half_year(temporal.month_of(temporal.from_epoch_seconds("t"))).alias("h")).collect()
    assert out[0]["d"] == dt.date(2004, 12, 31) and out[0]["h"] == "Late Year"
    assert out[1]["d"] == dt.date(2005, 1, 1) and out[1]["h"] == "Early Year"


def test_trip_time_parse_12_hour(spark):
    df = spark.createDataFrame([("01/31/2014 12:05:00 AM",), ("01/31/2014 11:45:00 PM",), ("junk",)], "s string")
    hours = [r[0] for r in df.select(temporal.hour_of_day(temporal.parse_timestamp("s", temporal.TRIP_TS_FORMAT))).collect()]
    assert hours == [0, 23, None]


def test_fixed_width_bins_left_closed(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 9.99, 10.0, 99.9, 100.0, -1.0, None]], "m double")
    got = [r[0] for r in df.select(buckets.fixed_width_bin("m", 10, 0, 100)).collect()]
    assert got == [0.0, 0.0, 10.0, 90.0, None, None, None]


LOG_LINES = [
    "081109 203615 148 INFO dfs.DataNode$PacketResponder: PacketResponder 1 for block blk_38865049064139660 terminating",
    "081109 203518 143 INFO dfs.DataNode$DataXceiver: Receiving block blk_-1608999687919862906 src: /10.250.19.102:54106 dest: /10.250.19.102:50010",
    "081109 203521 145 INFO dfs.DataNode$PacketResponder: Received block blk_-1608999687919862906 of size 91178 from /10.250.10.6",
    "081109 203518 35 INFO dfs.FSNamesystem: BLOCK* NameSystem.addStoredBlock: blockMap updated: 10.251.107.19:50010 is added to blk_-3544583377289625738 size 67108864",
    "garbage",
]


def test_log_fields(spark):
    df = spark.createDataFrame([(v,) for v in LOG_LINES], "value string")
    rows = logs.block_fields(logs.parse_log_lines(df)).collect()
    r0, r1, r2, r3, r4 = rows
    assert r0["event_ts"] == dt.datetime(2008, 11, 9, 20, 36, 15)
    assert r0["component"] == "PacketResponder" and r0["block_id"] == "blk_38865049064139660"
    assert r0["source"] is None and r0["block_size"] is None and r0["ip"] is None
    assert r1["component"] == "DataXceiver" and r1["source"] == "/10.250.19.102:54106"
    assert r1["hostname"] == "10.250.19.102"
    assert r2["block_size"] == 91178 and r2["hostname"] is None and r2["ip"] == "10.250.10.6"
    assert r3["component"] == "FSNamesystem" and r3["block_size"] == 67108864 and r3["ip"] == "10.251.107.19"
    assert r4["event_ts"] is None and r4["component"] is None and r4["log_level"] is None


def test_log_fields_keep_unmatched_and_full_component(spark):
    df = spark.createDataFrame([(LOG_LINES[0],), ("garbage",)], "value string")
    rows = logs.parse_log_lines(df, keep_unmatched=True, component_pattern=logs.FULL_COMPONENT_PATTERN).collect()
    assert rows[0]["component"] == "dfs.DataNode$PacketResponder"
    assert rows[1]["component"] == "" and rows[1]["message"] == ""


def test_value_list_position(spark):
    from tessera.functions.text import position_in
    df = spark.createDataFrame([("Monday",), ("Sunday",), ("Funday",), (None,)], "d string")
    got = [r[0] for r in df.select(position_in("d", temporal.WEEKDAY_ORDER)).collect()]
    assert got == [1, 7, 0, None]


def test_ansi_safe_casts(spark):
    from tessera.functions.numeric import safe_div, try_cast
    df = spark.createDataFrame([("12", 0), ("x", 2)], "s string, d int")
    rows = df.select(try_cast("s", "int").alias("i"), safe_div(F.lit(4), "d").alias("q")).collect()
    assert rows[0]["i"] == 12 and rows[0]["q"] is None
    assert rows[1]["i"] is None and rows[1]["q"] == 2.0


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(min_value=-50, max_value=150, allow_nan=False, width=32), min_size=1, max_size=30))
def test_bins_partition_the_range(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    rows = df.select("v", buckets.fixed_width_bin("v", 15, 0, 120).alias("b")).collect()
    for r in rows:
        if 0 <= r["v"] < 120:
            assert r["b"] is not None and r["b"] <= r["v"] < r["b"] + 15 and r["b"] % 15 == 0
        else:
            assert r["b"] is None
