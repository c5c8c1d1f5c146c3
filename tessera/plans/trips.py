"""Trip fare metrics and the trip graph (composites C18-C21, G1-G12 bindings).

Column names follow the taxi CSV (``Fare``, ``Trip Miles``, ``Trip Seconds``,
``Trip Start Timestamp``) but are parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.numeric import seconds_to_minutes, try_cast
from tessera.functions.temporal import TRIP_TS_FORMAT, hour_of_day, parse_timestamp
from tessera.operators.aggregates import binned_average, group_agg, summary_stats
from tessera.operators.clean import drop_nulls
from tessera.session import checkpoint_root
from tessera.operators.graph import Graph, edges_from_rows, vertices_from_endpoints


def fare_metrics(raw: DataFrame, fare: str = "Fare", miles: str = "Trip Miles", seconds: str = "Trip Seconds",
                 start: str = "Trip Start Timestamp", ts_format: str = TRIP_TS_FORMAT) -> DataFrame:
    """Typed ``fare, trip_miles, trip_seconds, hour_of_day``; rows with any NULL dropped."""
    return drop_nulls(raw.select(
        try_cast(F.col(f"`{fare}`"), "double").alias("fare"),
        try_cast(F.col(f"`{miles}`"), "double").alias("trip_miles"),
        try_cast(F.col(f"`{seconds}`"), "int").alias("trip_seconds"),
        hour_of_day(parse_timestamp(F.col(f"`{start}`"), ts_format)).alias("hour_of_day"),
    ))


def fare_summary(metrics: DataFrame) -> DataFrame:
    """Count / mean / stddev / min / max of fare, miles and seconds."""
    return summary_stats(metrics, ["fare", "trip_miles", "trip_seconds"])


def avg_fare_by(metrics: DataFrame, key: str) -> DataFrame:
    """C20: average fare per distinct value of ``key``, in key order."""
    return group_agg(metrics, key, {"avg_fare": F.avg("fare")}).orderBy(key)


def avg_fare_by_miles_bin(metrics: DataFrame, width: float = 10, high: float = 100) -> DataFrame:
    """Average fare per left-closed 10-mile bin in [0, 100)."""
    return binned_average(metrics, "trip_miles", "fare", width, 0, high, "miles_bin", "avg_fare", "trips")


def avg_fare_by_duration_bin(metrics: DataFrame, width_min: float = 15, high_min: float = 120) -> DataFrame:
    """Average fare per left-closed 15-minute bin of trip duration in [0, 120)."""
    m = metrics.withColumn("trip_minutes", seconds_to_minutes("trip_seconds"))
    return binned_average(m, "trip_minutes", "fare", width_min, 0, high_min, "minutes_bin", "avg_fare", "trips")


def trip_graph(trips: DataFrame) -> Graph:
    """Vertices from pickup/dropoff areas, edges = trips with their metrics."""
    vertices = vertices_from_endpoints(
        trips,
        [{"id": "pickup_area", "label": "pickup_label"}, {"id": "dropoff_area", "label": "dropoff_label"}],
        order_by=["label"], types={"id": "int"})
    edges = edges_from_rows(trips, "pickup_area", "dropoff_area",
                            {"trip_miles": "trip_miles", "trip_seconds": "trip_seconds", "fare": "fare"},
                            {"src": "int", "dst": "int", "trip_miles": "double", "trip_seconds": "int",
                             "fare": "double"})
    return Graph(vertices, edges)


def folded_trip_graph(trips: DataFrame) -> Graph:
    """The trip graph with one edge per pair of areas: ``trips`` of them, ``fare`` in total.

    One pass over the trips, whose result is checkpointed: vertices and edges both come from it.
    """
    pairs = trips.groupBy(F.col("pickup_area").try_cast("int").alias("src"), F.col("dropoff_area").try_cast("int").alias("dst")).agg(
        F.count(F.lit(1)).alias("trips"), F.sum(F.col("fare").cast("double")).alias("fare"),
        F.min("pickup_label").alias("src_label"), F.min("dropoff_label").alias("dst_label"))
    checkpoint_root(pairs.sparkSession)
    pairs = pairs.checkpoint(eager=True)
    vertices = vertices_from_endpoints(pairs, [{"id": "src", "label": "src_label"}, {"id": "dst", "label": "dst_label"}], order_by=["label"])
    return Graph(vertices, edges_from_rows(pairs, "src", "dst", {"trips": "trips", "fare": "fare"}))
