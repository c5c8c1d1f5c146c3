"""CSV sources with spaced headers, declared schemas and the taxi graph path (FIXTURES.md section 3)."""

import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from tessera.operators import graph as G
from tessera.operators.clean import impose_schema, split_rejects
from tessera.plans import trips as P
from tessera.sources.csv import read_csv
from tessera.sources.sinks import preview, row_count, scalar_frame, write_csv
from tessera.streaming import logs as SL
from tessera.streaming.sinks import run_stream
from tessera.streaming.sources import line_stream

HEADER = ("Trip Start Timestamp,Pickup Community Area,Dropoff Community Area,Pickup Centroid Latitude,"
          "Pickup Census Tract,Trip Miles,Trip Seconds,Fare")
ROWS = [
    "01/31/2014 12:05:00 AM,8,8,41.9,t1,0,60,5.0",
    "01/31/2014 11:45:00 PM,8,32,41.8,t0,9.99,899,10.0",
    "01/31/2014 01:00:00 PM,8,32,41.7,t2,10,900,12.0",
    "01/31/2014 02:00:00 PM,,32,41.0,t3,99.9,7199,30.0",
    "01/31/2014 03:00:00 PM,32,77,41.5,t4,100,7200,abc",
]


@pytest.fixture()
def taxi_csv(tmp_dir):
    folder = os.path.join(tmp_dir, "taxi")
    os.makedirs(folder)
    for i, chunk in enumerate([ROWS[:2], ROWS[2:]]):       # a folder of part files (S5)
        with open(os.path.join(folder, f"part-{i:05d}.csv"), "w") as f:
            f.write(HEADER + "\n" + "\n".join(chunk) + "\n")
    return folder


def test_all_strings_and_inferred_reads(spark, taxi_csv):
    raw = read_csv(spark, taxi_csv)                          # S1: header, all strings
    assert raw.count() == 5 and all(t == "string" for _, t in raw.dtypes)
    inferred = read_csv(spark, taxi_csv, infer=True)         # S2: opt-in inference
    assert dict(inferred.dtypes)["Trip Seconds"] == "int"


def test_declared_schema_with_spaced_names(spark, taxi_csv):
    schema = StructType([StructField("src", IntegerType()), StructField("fare", DoubleType()),
                         StructField("tract", StringType())])
    typed = impose_schema(read_csv(spark, taxi_csv), schema,
                          {"src": "Pickup Community Area", "fare": "Fare", "tract": "Pickup Census Tract"})
    rows = typed.collect()
    assert sorted(rows, key=lambda r: (r["tract"]))[-1]["fare"] is None   # 'abc' -> NULL, no job failure
    assert sorted([r["src"] for r in rows], key=lambda v: (v is None, v)) == [8, 8, 8, 32, None]
    good, bad = split_rejects(typed, ["src", "fare"])
    assert good.count() == 3 and bad.count() == 2


def test_fare_metrics_and_bins_from_csv(spark, taxi_csv):
    m = P.fare_metrics(read_csv(spark, taxi_csv))
    assert m.count() == 4                                     # 'abc' fare dropped
    assert sorted(r["hour_of_day"] for r in m.collect()) == [0, 13, 14, 23]
    miles = {r["miles_bin"]: r["trips"] for r in P.avg_fare_by_miles_bin(m).collect()}
    assert miles == {0.0: 2, 10.0: 1, 90.0: 1}
    dur = {r["minutes_bin"]: r["trips"] for r in P.avg_fare_by_duration_bin(m).collect()}
    assert dur == {0.0: 2, 15.0: 1, 105.0: 1}


def test_trip_graph_from_csv(spark, taxi_csv):
    raw = read_csv(spark, taxi_csv)
    trips = raw.select(F.col("`Pickup Community Area`").alias("pickup_area"),
                       F.col("`Dropoff Community Area`").alias("dropoff_area"),
                       F.col("`Pickup Census Tract`").alias("pickup_label"),
                       F.col("`Pickup Census Tract`").alias("dropoff_label"),
                       F.col("`Trip Miles`").alias("trip_miles"), F.col("`Trip Seconds`").alias("trip_seconds"),
                       F.col("Fare").alias("fare"))
    g = P.trip_graph(trips)
    assert {r["id"]: r["label"] for r in g.vertices.collect()} == {8: "t0", 32: "t0", 77: "t4"}
    assert g.edges.count() == 4                               # NULL pickup dropped, parallel edges kept
    assert G.self_loops(g.edges).count() == 1
    enriched = G.enriched_edges(g, ["fare"]).collect()
    assert sorted((r["src"], r["dst"], r["fare"]) for r in enriched) == [(8, 8, 5.0), (8, 32, 10.0), (32, 77, None)]


def test_sinks(spark, tmp_dir):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    path = write_csv(df, os.path.join(tmp_dir, "out"), single_file=True)
    back = read_csv(spark, path, schema="id long, x long")
    assert back.count() == 10 and len([f for f in os.listdir(path) if f.startswith("part-")]) == 1
    assert preview(df, 3).count() == 3
    assert row_count(df).first()["row_count"] == 10
    assert scalar_frame(df, F.max("x"), "m").first()["m"] == 18


def test_processing_time_trigger(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    path = os.path.join(src, "a.log")
    with open(path, "w") as f:
        f.write("081109 203518 143 INFO dfs.DataNode$DataXceiver: Receiving block blk_-1 src: /10.0.0.1:5 dest: /10.0.0.1:50010\n")
    os.utime(path, (int(time.time()) - 10,) * 2)
    spec = SL.host_block_operations(line_stream(spark, src))
    run = run_stream(spec.frame, spec.mode, "trigger", spec.keys, trigger={"processingTime": "1 second"})
    assert [tuple(r) for r in run.result().collect()] == [("10.0.0.1", 1)]


def test_cli_list(capsys):
    from tessera.__main__ import main
    assert main(["list"]) == 0
    listed = capsys.readouterr().out.split("\n")
    assert "time_of_day_distribution" in listed and "stream_progress" in listed
