"""Keyed state, chained windows, late rows and state inspection on small streams."""

import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from tessera.streaming import stateful as SF
from tessera.session import delete_scratch, scratch_path
from tessera.streaming.sinks import preview_stream, run_stream
from tessera.streaming.sources import replay, replay_in_time_order

T0 = dt.datetime(2024, 3, 1)
SCHEMA = "at timestamp, host string, n long"


def _events(counts):
    """``counts``: {(hour, host): events}."""
    return [(T0 + dt.timedelta(hours=h, seconds=3 * i), host, i) for (h, host), n in counts.items() for i in range(n)]


def _hours():
    import random
    rng = random.Random(4)
    counts = {(h, host): rng.randint(1, 9) for h in range(30) for host in ("a", "b", None) if rng.random() < 0.8}
    counts[(20, "a")] = 90
    return counts


def _expected(counts, deviations=2.0, min_windows=3):
    out = {}
    for host in {h for _, h in counts}:
        before = []
        for hour in sorted(t for t, h in counts if h == host):
            n = counts[hour, host]
            mean = statistics.fmean(before) if before else None
            spread = statistics.stdev(before) if len(before) > 1 else None
            flag = len(before) >= min_windows and spread is not None and abs(n - mean) > deviations * spread
            out[hour, host] = (n, len(before), mean, spread, flag)
            before.append(n)
    return out


def _told(frame):
    return {(int((r.window_start - T0).total_seconds() // 3600), r.host):
            (r.event_count, r.earlier_windows, r.mean_before, r.stddev_before, r.unusual) for r in frame.collect()}


def _same(got, want):
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert got[k][0] == w[0] and got[k][1] == w[1] and got[k][4] == w[4], k
        assert got[k][2] == pytest.approx(w[2]) and got[k][3] == pytest.approx(w[3])


def test_baselines_hold_over_batches_and_a_restart(spark, tmp_dir):
    counts = _hours()
    rows = spark.createDataFrame(_events(counts) + [(T0 + dt.timedelta(hours=40), "z", 0)], SCHEMA)
    early = rows.filter(F.col("at") < F.lit(T0 + dt.timedelta(hours=17, minutes=1)))
    late = rows.filter(F.col("at") >= F.lit(T0 + dt.timedelta(hours=17, minutes=1)))

    def query(folder_rows):
        stream = folder_rows.withWatermark("at", "5 seconds")
        with SF.rocksdb_state(spark):
            return run_stream(SF.host_baselines(stream, ["host"], "at"), "append", "baselines", out=f"{tmp_dir}/run")

    source = f"{tmp_dir}/in"
    replay_in_time_order(spark, early, "at", f"{source}/first", batches=3)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{source}/*/*")
    first = query(stream.select("at", "host", "n"))
    seen = _told(first.result())
    assert 0 < len(seen) < len(counts)
    replay_in_time_order(spark, late, "at", f"{source}/second", batches=2)
    second = query(stream.select("at", "host", "n"))
    want = _expected(counts)
    _same(_told(second.result()), want)
    assert want[20, "a"][4] and any(not w[4] for w in want.values())


def test_a_silent_key_is_forgotten(spark, tmp_dir):
    counts = {(h, "a"): 3 + h % 2 for h in range(6)} | {(h, "b"): 2 for h in range(60)} | {(50, "a"): 40}
    rows = spark.createDataFrame(_events(counts), SCHEMA)
    stream = replay_in_time_order(spark, rows, "at", tmp_dir, batches=6).withWatermark("at", "5 seconds")
    with SF.rocksdb_state(spark):
        told = _told(run_stream(SF.host_baselines(stream, ["host"], "at", idle_seconds=10 * 3600), "append", "idle").result())
    assert told[5, "a"][1] == 5
    assert told[50, "a"][1] == 0 and not told[50, "a"][4]
    assert told[50, "b"][1] == 50


def test_windows_of_windows(spark, tmp_dir):
    rows = spark.createDataFrame(_events({(h, x): 5 + 7 * h % 11 for h in range(6) for x in "ab"}), SCHEMA)
    stream = replay_in_time_order(spark, rows, "at", tmp_dir).withWatermark("at", "5 seconds")
    got = run_stream(SF.windows_of_windows(stream, ["host"], "at", "6 seconds", "1 hour"), "append", "chained").result().collect()
    assert {(r.window_start.hour, r.host) for r in got} == {(h, x) for h in range(5) for x in "ab"}
    for r in got:
        n = 5 + 7 * r.window_start.hour % 11
        assert (r.event_count, r.max_inner_count, r.inner_windows) == (n, 2, -(-n // 2))


def test_rows_in_are_rows_counted_and_rows_late(spark, tmp_dir):
    rows = spark.createDataFrame(_events({(h, "a"): 20 for h in range(12)}) + [(None, "a", 0)], SCHEMA)
    hour = F.hour("at")
    members = [F.col("at").isNull() | (hour < 3) & (F.col("n") > 2), (hour >= 3) & (hour < 6), (hour >= 6) & (hour < 9),
               (hour < 3) & (F.col("n") <= 2), hour >= 9]
    stream = replay(spark, rows, members, tmp_dir)
    counts, late = SF.late_side(stream, "at", "1 hour", "5 seconds", "late")
    kept = {r.window_start.hour: r.event_count for r in counts.result().collect()}
    assert late.count() == 9 and late.columns == ["at", "host", "n"]
    assert kept == {h: 20 - 3 * (h < 3) for h in range(12)}
    assert SF.dropped_rows(counts) == 3  # after partial aggregation: one per window
    in_order, none = SF.late_side(replay_in_time_order(spark, rows, "at", f"{tmp_dir}/b"), "at", "1 hour", "5 seconds", "none")
    assert none.count() == 0 and SF.dropped_rows(in_order) == 0
    assert sum(r.event_count for r in in_order.result().collect()) == 240


def test_state_is_read_from_the_checkpoint(spark, tmp_dir):
    rows = spark.createDataFrame(_events({(h, x): h + 1 for h in range(4) for x in ("a", "b", None)}), SCHEMA)
    stream = replay_in_time_order(spark, rows, "at", tmp_dir, batches=4)
    run = run_stream(stream.groupBy("host").agg(F.sum("n").alias("total")), "complete", "sums")
    now = {r.host: r.total for r in SF.running_sums(spark, run, "host", "total").collect()}
    assert now == {r.host: r.total for r in run.result().collect()} == {x: 10 for x in ("a", "b", None)}
    then = {r.host: r.total for r in SF.running_sums(spark, run, "host", "total", batch_id=1).collect()}
    assert then == {x: 1 for x in ("a", "b", None)}
    assert SF.state_operators(spark, run.path).first().operatorName == "stateStoreSave"


def test_replay_keeps_batches_apart(spark, tmp_dir):
    rows = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 7 > 0, F.timestamp_seconds("id")).alias("at"))
    stream = replay(spark, rows, [F.col("id") >= 600, F.lit(False), F.col("id") < 300, (F.col("id") >= 300) & (F.col("id") < 600)], tmp_dir,
                    rows_per_file=120)
    sizes = []
    query = stream.writeStream.foreachBatch(lambda b, i: sizes.append((b.agg(F.min("id"), F.max("id"), F.count("*")).first()))).trigger(availableNow=True).start()
    query.awaitTermination()
    assert [tuple(s) for s in sizes] == [(600, 999, 400), (0, 299, 300), (300, 599, 300)]
    assert replay(spark, rows.filter("false"), [F.lit(True)], f"{tmp_dir}/none").isStreaming


def test_a_preview_stops_at_its_cap(spark, tmp_dir):
    rows = spark.range(500).withColumn("at", F.timestamp_seconds("id"))
    shown = preview_stream(replay_in_time_order(spark, rows, "at", tmp_dir), 130, "preview")
    assert shown.count() == 130 and shown.agg(F.max("id")).first()[0] < 250  # the first batches, not all
    assert preview_stream(replay_in_time_order(spark, rows, "at", f"{tmp_dir}/b"), 10_000, "preview").count() == 500


def test_scratch_is_deleted_when_the_caller_is_done(spark):
    delete_scratch(spark)
    path = scratch_path(spark, "mine")
    spark.range(3).write.parquet(path)
    scratch_path(spark, "never_written")
    assert spark.read.parquet(path).count() == 3
    assert delete_scratch(spark) == 1 and delete_scratch(spark) == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_a_batch_is_read_by_many_tasks(spark, tmp_dir):
    rows = spark.range(1_000_000, numPartitions=4).select("id", F.timestamp_seconds("id").alias("at"))
    sizes = []
    query = (replay_in_time_order(spark, rows, "at", tmp_dir, batches=2).writeStream
             .foreachBatch(lambda b, i: sizes.append([r["count"] for r in b.groupBy(F.spark_partition_id()).count().collect()]))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    assert sum(map(sum, sizes)) == 1_000_000
    assert [len(s) for s in sizes] == [4, 4]  # as many as the session's shuffles have


def test_uneven_batches_of_several_files_stay_apart(spark, tmp_dir):
    # Over a quarter of the rows have the first time, so the first batch is empty; the last has fewer rows than files.
    rows = spark.range(1000, numPartitions=4).select("id", F.timestamp_seconds(F.greatest(F.lit(0), F.col("id") - 400)).alias("at"))

    def batches(stream):
        found = []
        query = stream.writeStream.foreachBatch(lambda b, i: found.append(tuple(b.agg(F.min("id"), F.max("id"), F.count("*")).first()))).trigger(availableNow=True).start()
        query.awaitTermination()
        return [b for b in found if b[2]]

    in_order = batches(replay_in_time_order(spark, rows, "at", f"{tmp_dir}/a", rows_per_file=70))
    assert sum(b[2] for b in in_order) == 1000
    assert all(x[1] < y[0] for x, y in zip(in_order, in_order[1:]))
    members = [F.col("id") < 2, (F.col("id") >= 2) & (F.col("id") < 700), F.col("id") >= 700]
    assert batches(replay(spark, rows, members, f"{tmp_dir}/b", rows_per_file=200)) == [(0, 1, 2), (2, 699, 698), (700, 999, 300)]
