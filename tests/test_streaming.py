"""Structured Streaming: batch = stream equivalence, late data, sliding windows (FIXTURES.md section 4)."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from tessera.plans import logs as L
from tessera.streaming import logs as SL
from tessera.streaming.sinks import progress_frame, run_stream, start_stream
from tessera.streaming.sources import line_stream, table_stream


def _line(ts: str, comp: str = "dfs.DataNode", level: str = "INFO", msg: str = "op") -> str:
    return f"{ts} 1 {level} {comp}: {msg}"


def _write(folder: str, name: str, lines: list[str], mtime: int) -> None:
    p = os.path.join(folder, name)
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(p, (mtime, mtime))


def test_append_drops_late_rows_and_waits_for_window_close(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    now = int(time.time())
    _write(src, "a.log", [_line("081109 203615"), _line("081109 203645"), _line("081109 203710")], now - 300)
    _write(src, "b.log", [_line("081109 203800")], now - 200)
    # third batch: a row far older than the watermark, and a new row
    _write(src, "c.log", [_line("081109 203000"), _line("081109 203830")], now - 100)
    lines = line_stream(spark, src, max_files_per_trigger=1)
    spec = SL.sliding_datanode_counts(lines, "60 seconds", "30 seconds", "5 seconds", mode="append")
    run = run_stream(spec.frame, spec.mode, "late")
    got = {(r["window_start"], r["datanode_count"]) for r in run.result().collect()}
    d = lambda h, m, s: dt.datetime(2008, 11, 9, h, m, s)
    # Spark drops a row when it is older than the watermark of the previous
    # batch (20:37:05 in batch 2); windows are written once the final
    # watermark (20:38:25) passes their end.
    assert got == {(d(20, 35, 30), 1), (d(20, 36, 0), 2), (d(20, 36, 30), 2), (d(20, 37, 0), 1)}
    assert [p["numInputRows"] for p in run.progress if p["numInputRows"]] == [3, 1, 2]


def test_sliding_update_counts_each_event_twice(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    now = int(time.time())
    _write(src, "a.log", [_line("081109 203615"), _line("081109 203645")], now - 200)
    _write(src, "b.log", [_line("081109 203650"), _line("081109 203615", comp="dfs.FSNamesystem")], now - 100)
    lines = line_stream(spark, src, max_files_per_trigger=1)
    spec = SL.sliding_datanode_counts(lines, mode="update")
    run = run_stream(spec.frame, spec.mode, "sliding", spec.keys)
    got = {r["window_start"].strftime("%H:%M:%S"): r["datanode_count"] for r in run.result().collect()}
    assert got == {"20:35:30": 1, "20:36:00": 3, "20:36:30": 2}
    assert sum(got.values()) == 2 * 3
    prog = progress_frame(spark, run).collect()
    assert sum(r["num_input_rows"] for r in prog) == 4


def test_complete_mode_equals_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    a = ["081109 203521 145 INFO dfs.DataNode$PacketResponder: Received block blk_-16 of size 91178 from /10.250.10.6",
         "081109 203518 143 INFO dfs.DataNode$DataXceiver: Receiving block blk_-16 src: /10.250.19.102:54106 dest: /10.250.19.102:50010"]
    b = ["081109 203518 35 INFO dfs.FSNamesystem: BLOCK* NameSystem.addStoredBlock: blockMap updated: 10.251.107.19:50010 is added to blk_-35 size 67108864",
         "081109 203519 143 WARN dfs.DataNode$DataXceiver: writeBlock blk_-9 received exception from /10.250.19.102:50010 size 10"]
    _write(src, "a.log", a, int(time.time()) - 200)
    _write(src, "b.log", b, int(time.time()) - 100)
    for spec_fn, batch_fn in [(SL.host_bytes, L.host_bytes), (SL.host_block_operations, L.host_block_operations)]:
        spec = spec_fn(line_stream(spark, src, max_files_per_trigger=1))
        streamed = {tuple(r) for r in run_stream(spec.frame, spec.mode, "complete", spec.keys).result().collect()}
        batch = {tuple(r) for r in batch_fn(spark.read.text(src)).collect()}
        assert streamed == batch
    bytes_by_host = {r["hostname"]: r["total_bytes"] for r in L.host_bytes(spark.read.text(src)).collect()}
    assert bytes_by_host == {None: 91178 + 67108864, "10.250.19.102": 10}
    # reference-exact mode: unmatched hosts are '' instead of NULL
    raw = {r["hostname"]: r["total_bytes"] for r in L.host_bytes(spark.read.text(src), keep_unmatched=True).collect()}
    assert raw == {"": 91178 + 67108864, "10.250.19.102": 10}


def test_per_batch_flag_and_rejects(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    lines = [_line("081109 203615", level="ERROR")] * 5 + [_line("081109 213615", level="ERROR")] + ["garbage"]
    _write(src, "a.log", lines, int(time.time()) - 100)
    spec = SL.level_window_counts(line_stream(spark, src), "ERROR", "1 hour")
    run = run_stream(spec.frame, spec.mode, "flag", spec.keys,
                     batch_transform=lambda b: L.busy_windows(b, "event_count"))
    got = [(r["window_start"].hour, r["event_count"], r["mean_count"]) for r in run.result().collect()]
    assert got == [(20, 5, 3.0)]
    rejects = L.unparsed_lines(L.parsed(spark.read.text(src))).collect()
    assert [r["value"] for r in rejects] == ["garbage"]


def test_parse_append_keeps_ingest_time_separate(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    _write(src, "a.log", [_line("081109 203615"), "garbage"], int(time.time()) - 100)
    lines = line_stream(spark, src)
    assert "ingest_ts" in lines.columns
    spec = SL.parsed_append(lines)
    rows = {r["value"]: r for r in run_stream(spec.frame, spec.mode, "parse").result().collect()}
    assert rows["garbage"]["event_ts"] is None
    assert rows[_line("081109 203615")]["event_ts"] == dt.datetime(2008, 11, 9, 20, 36, 15)


def test_restart_resumes_from_checkpoint(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    out = os.path.join(tmp_dir, "out")
    line = "081109 203518 143 INFO dfs.DataNode$DataXceiver: Receiving block blk_-{i} src: /10.0.0.{h}:5 dest: x"
    _write(src, "a.log", [line.format(i=i, h=1) for i in range(3)], int(time.time()) - 200)
    spec = SL.host_block_operations(line_stream(spark, src))
    first = run_stream(spec.frame, spec.mode, "restart", spec.keys, out=out)
    assert {tuple(r) for r in first.result().collect()} == {("10.0.0.1", 3)}
    # new input arrives; the query restarts from its checkpoint (offsets + state)
    _write(src, "b.log", [line.format(i=i, h=2) for i in range(2)] + [line.format(i=9, h=1)], int(time.time()) - 100)
    spec = SL.host_block_operations(line_stream(spark, src))
    second = run_stream(spec.frame, spec.mode, "restart", spec.keys, out=out)
    assert {tuple(r) for r in second.result().collect()} == {("10.0.0.1", 4), ("10.0.0.2", 2)}
    assert sum(p["numInputRows"] for p in second.progress) == 3          # a.log is not re-read


def test_complete_snapshot_of_a_batch_without_rows_is_empty(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    now = int(time.time())
    _write(src, "a.log", [_line("081109 203615", level="ERROR")] * 2 + [_line("081109 213615", level="ERROR")], now - 200)
    _write(src, "b.log", [_line("081109 213616", level="ERROR")], now - 100)  # both hours equal: none above the mean
    spec = SL.level_window_counts(line_stream(spark, src, max_files_per_trigger=1), "ERROR", "1 hour")
    run = run_stream(spec.frame, spec.mode, "flag2", spec.keys, batch_transform=lambda b: L.busy_windows(b, "event_count"))
    assert run.result().collect() == []
    assert "window_start" in run.result().columns


def test_timeout_raises_and_the_query_can_resume(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    for i in range(12):
        _write(src, f"{i:03d}.log", [_line("081109 203615")] * 5, int(time.time()) - 500 + i)
    out = os.path.join(tmp_dir, "out")
    spec = SL.tumbling_counts(line_stream(spark, src, max_files_per_trigger=1))
    with pytest.raises(TimeoutError):
        run_stream(spec.frame, spec.mode, "slow", spec.keys, timeout_s=0.5, out=out)
    spec = SL.tumbling_counts(line_stream(spark, src, max_files_per_trigger=1))
    assert [r["event_count"] for r in run_stream(spec.frame, spec.mode, "slow", spec.keys, out=out).result().collect()] == [60]


def test_progress_has_every_batch_and_updates_are_compacted(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    n = 105
    for i in range(n):
        _write(src, f"{i:03d}.log", [_line(f"081109 2036{i % 60:02d}")], int(time.time()) - 2000 + i)
    lines = line_stream(spark, src, max_files_per_trigger=1)
    run = run_stream(lines.select("value"), "append", "many")
    reports = progress_frame(spark, run).collect()
    assert sum(r["num_input_rows"] for r in reports) == n == run.result().count() and len(reports) >= n
    # Update mode over more batches than a compaction takes: the newest row per key, bounded folders.
    few = os.path.join(tmp_dir, "few")
    os.makedirs(few)
    for i in range(24):
        _write(few, f"{i:03d}.log", [_line(f"081109 2036{i % 4}0")], int(time.time()) - 2000 + i)
    spec = SL.tumbling_counts(line_stream(spark, few, max_files_per_trigger=1), watermark=None, mode="update")
    run = run_stream(spec.frame, spec.mode, "upd", spec.keys)
    assert sorted(r["event_count"] for r in run.result().collect()) == [6, 6, 6, 6]
    assert len([d for d in os.listdir(f"{run.path.removeprefix('file:')}/log") if d.startswith("_slot")]) <= 20
    run.delete()
    assert not os.path.exists(run.path.removeprefix("file:"))


def test_table_stream_reads_a_file_or_a_folder(spark, tmp_dir):
    rows = spark.range(50).withColumnRenamed("id", "n")
    rows.repartition(3).write.parquet(f"{tmp_dir}/many.parquet")
    rows.coalesce(1).write.parquet(f"{tmp_dir}/tmp")
    part = [f for f in os.listdir(f"{tmp_dir}/tmp") if f.startswith("part-")][0]
    os.rename(f"{tmp_dir}/tmp/{part}", f"{tmp_dir}/one.parquet")
    for table in ("many", "one"):
        run = run_stream(table_stream(spark, tmp_dir, table, max_files_per_trigger=1), "append", table)
        assert sorted(r["n"] for r in run.result().collect()) == list(range(50))


def test_long_running_query_is_read_while_it_runs(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    _write(src, "a.log", [_line("081109 203615")], int(time.time()) - 100)
    spec = SL.tumbling_counts(line_stream(spark, src))
    run = start_stream(spec.frame, spec.mode, "live", spec.keys, trigger={"processingTime": "1 second"})
    try:
        run.query.processAllAvailable()
        assert [r["event_count"] for r in run.result().collect()] == [1]
        _write(src, "b.log", [_line("081109 203616")] * 2, int(time.time()) - 10)
        run.query.processAllAvailable()
        assert [r["event_count"] for r in run.result().collect()] == [3] and run.query.isActive
    finally:
        run.stop()


def test_complete_results_keep_their_order(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    line = "081109 203518 143 INFO dfs.DataNode$DataXceiver: Receiving block blk_-{i} src: /10.0.0.{h}:5 dest: x"
    _write(src, "a.log", [line.format(i=i, h=h) for h in range(1, 9) for i in range((h * 3) % 8 + 1)], int(time.time()) - 200)
    spec = SL.host_block_operations(line_stream(spark, src))
    counts = [r["block_operations"] for r in run_stream(spec.frame, spec.mode, "order", spec.keys, order=spec.order).result().collect()]
    assert counts == sorted(counts, reverse=True) and len(counts) == 8


def test_json_lines_with_a_declared_schema(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    _write(src, "a.json", ['{"value": "x", "n": 1}'], int(time.time()) - 100)
    run = run_stream(line_stream(spark, src, fmt="json", schema="value string, n int"), "append", "json")
    assert [(r["value"], r["n"]) for r in run.result().collect()] == [("x", 1)]


def test_reports_of_all_batches_are_kept_without_polling(spark, tmp_dir):
    from tessera.streaming import sinks
    from tessera.streaming.sources import replay_in_time_order

    rows = spark.range(40).withColumn("at", F.timestamp_seconds("id"))
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", None)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        stream = replay_in_time_order(spark, rows, "at", tmp_dir, batches=8)
        run = sinks.start_stream(stream, "append", "unpolled")
        assert run.query.awaitTermination(120)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before or "100")
    assert len(run.query.recentProgress) <= 2
    assert sum(p["numInputRows"] for p in run.progress) == 40 and len([p for p in run.progress if p["numInputRows"]]) == 8
