"""Stand-in inputs derived *by Spark* from the driver's tables.

The reference's own datasets (tweets, movie ratings, taxi trips, HDFS log
lines) are not shipped, so each composite is bound to a table of the same
shape.  Every stand-in is a lazy projection/join of the given tables, so its
size grows with the scale factor.

* tweets  -> ``events``: local time text from ``ts``, whole-hour zone from ``user_id``
* ratings -> ``lineitem`` (item = part, rating = quantity mapped onto the
             0.5-5.0 half-star scale: ``ceil(q / 5) / 2``) and ``orders``
             (user = customer, time = order date)
* trips   -> ``lineitem`` joined to its order's customer and its supplier:
             pickup area = customer nation, dropoff area = supplier nation
* fare metrics -> ``events`` (fare = value, miles = JSON ``props.k``,
             seconds = 60 * user_id, start time as 12-hour text)
* a sparse graph -> parts, with an edge from each order line's part to the
             next line's part (``basket_edges``)
* HDFS log lines -> one line per ``events`` row in the HDFS text layout
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.temporal import TRIP_TS_FORMAT, TWEET_TS_FORMAT
from tessera.sources.tables import Tables

# Stand-in mapping of event types to HDFS log level and logger.
EVENT_LOG_LEVEL = {"error": "ERROR", "signup": "WARN"}          # others: INFO
EVENT_COMPONENT = {
    "click": "dfs.DataNode$DataXceiver",
    "view": "dfs.DataNode$PacketResponder",
    "purchase": "dfs.FSNamesystem",
    "signup": "dfs.DataNode",
    "error": "dfs.DataNode",
}


def tweets(t: Tables) -> DataFrame:
    """``event_id, longitude, latitude, timestamp (text), timezone (text)``."""
    e = t.events
    return e.select(
        "event_id",
        F.col("value").cast("string").alias("longitude"),
        F.col("user_id").cast("string").alias("latitude"),
        F.date_format("ts", TWEET_TS_FORMAT).alias("timestamp"),
        # some rows lack a usable zone, as real ones do
        F.when(F.col("event_id") % 53 == 0, F.lit("n/a")).otherwise((F.col("user_id") % 5).cast("string")).alias("timezone"),
    )


def ratings(t: Tables) -> DataFrame:
    """``item, rating, ts`` from lineitem; ratings are half stars 0.5-5.0 (exact in binary)."""
    li = t.lineitem
    return li.select(F.col("l_partkey").alias("item"),
                     (F.ceil(F.col("l_quantity") / F.lit(5)) / F.lit(2.0)).alias("rating"),
                     F.col("l_shipdate").alias("ts"))


def items(t: Tables) -> DataFrame:
    """``item, title``: parts with their two-word names as the tag text."""
    return t.part.select(F.col("p_partkey").alias("item"), F.col("p_name").alias("title"))


def trips(t: Tables) -> DataFrame:
    """Trip rows: ``pickup_area, dropoff_area, pickup_label, dropoff_label, trip_miles, trip_seconds, fare``."""
    li = t.lineitem.select("l_orderkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_linenumber")
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    s = t.supplier.select("s_suppkey", "s_nationkey", "s_name")
    # orders x customer first (orders-sized), so the big lineitem side is
    # shuffled only for the order key and the supplier key.
    oc = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_nationkey", "c_mktsegment")
    j = li.join(oc, li.l_orderkey == oc.o_orderkey).join(s, F.col("l_suppkey") == s.s_suppkey)
    return j.select(
        # some trips lack an area or a label, as real ones do
        F.when(F.col("l_orderkey") % 31 != 0, F.col("c_nationkey")).alias("pickup_area"),
        F.when(F.col("l_orderkey") % 37 != 0, F.col("s_nationkey")).alias("dropoff_area"),
        F.when(F.col("l_orderkey") % 3 != 0, F.col("c_mktsegment")).alias("pickup_label"),
        F.col("s_name").alias("dropoff_label"),
        F.col("l_quantity").alias("trip_miles"),
        (F.col("l_linenumber") * F.lit(60)).alias("trip_seconds"),
        F.col("l_extendedprice").alias("fare"),
    )


def basket_edges(t: Tables) -> DataFrame:
    """A sparse, deep graph over parts: each order line points to the next line's part.

    An equi-join of lineitem with itself on ``(order, line number + 1)`` --
    one edge per consecutive line pair, never all pairs of an order.  (A window's
    ``lead`` would not do: line numbers repeat within some orders.)
    """
    a = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("src"))
    b = t.lineitem.select(F.col("l_orderkey").alias("o2"), F.col("l_linenumber").alias("n2"),
                          F.col("l_partkey").alias("dst"))
    return (a.join(b, (a.l_orderkey == b.o2) & (b.n2 == a.l_linenumber + F.lit(1)))
            .select("src", "dst"))


def fare_trips(t: Tables) -> DataFrame:
    """Raw fare rows with text fields, like the taxi CSV: ``Trip Start Timestamp`` etc."""
    e = t.events
    return e.select(
        F.date_format("ts", TRIP_TS_FORMAT).alias("Trip Start Timestamp"),
        # junk and gaps, as in real fare files
        F.when(F.col("event_id") % 97 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("Fare"),
        F.get_json_object("props", "$.k").alias("Trip Miles"),
        F.when(F.col("event_id") % 89 != 0, (F.col("user_id") * F.lit(60)).cast("string")).alias("Trip Seconds"),
    )


def regions(t: Tables) -> DataFrame:
    """``region, min_x, max_x, min_y, max_y``: one box per nation, of many sizes, some overlapping."""
    k = F.col("n_nationkey")
    low_x, low_y = (k * 37 % 100).cast("double"), (k * 53 % 700).cast("double")
    return t.nation.select(F.col("n_name").alias("region"), low_x.alias("min_x"), (low_x + F.pow(F.lit(2.0), k % 7) * 1.5).alias("max_x"),
                           low_y.alias("min_y"), (low_y + F.pow(F.lit(2.0), k % 9) * 2.5).alias("max_y"))


def log_lines(t: Tables) -> DataFrame:
    """``event_id, value``: one HDFS-layout log line per event row."""
    return log_lines_from_events(t.events)


def log_lines_from_events(e: DataFrame) -> DataFrame:
    """Same as ``log_lines`` for any (batch or streaming) frame with the events columns."""
    level = F.lit("INFO")
    for k, v in EVENT_LOG_LEVEL.items():
        level = F.when(F.col("event_type") == k, F.lit(v)).otherwise(level)
    comp = F.lit("dfs.DataNode")
    for k, v in EVENT_COMPONENT.items():
        comp = F.when(F.col("event_type") == k, F.lit(v)).otherwise(comp)
    eid = F.col("event_id").cast("string")
    uid = F.col("user_id").cast("string")
    size = F.round(F.col("value") * F.lit(1000)).cast("long").cast("string")
    msg = (F.when(F.col("event_type") == "click",
                  F.concat(F.lit("Receiving block blk_"), eid, F.lit(" src: /10.0."), uid, F.lit(".1:5"),
                           eid, F.lit(" dest: /10.0."), uid, F.lit(".1:50010")))
           .when(F.col("event_type") == "view",
                 F.concat(F.lit("Received block blk_"), eid, F.lit(" of size "), size,
                          F.lit(" from /10.0."), uid, F.lit(".2")))
           .when(F.col("event_type") == "purchase",
                 F.concat(F.lit("BLOCK* NameSystem.addStoredBlock: blockMap updated: 10.0."), uid,
                          F.lit(".3:50010 is added to blk_-"), eid, F.lit(" size "), size))
           .when(F.col("event_type") == "signup",
                 F.concat(F.lit("PacketResponder 1 for block blk_"), eid, F.lit(" terminating")))
           .otherwise(F.concat(F.lit("writeBlock blk_"), eid, F.lit(" received exception from /10.0."),
                               uid, F.lit(".4:50010"))))
    line = F.concat(F.date_format("ts", "yyMMdd HHmmss"), F.lit(" "), uid, F.lit(" "), level, F.lit(" "),
                    comp, F.lit(": "), msg)
    return e.select("event_id", line.alias("value"))
