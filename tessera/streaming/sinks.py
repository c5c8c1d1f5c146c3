"""Streaming sinks: run a query and read its result as a table.

Results are written to the cluster's shared checkpoint folder, never collected
on the driver:

* ``append``   -- parquet file sink (exactly-once through the sink's log);
* ``complete`` -- ``foreachBatch`` overwrites one of two slots
  (``batch_id % 2``) with the batch's full table, then records the batch id of
  the slot beside it; the reader takes the slot of the newest batch, also when
  that batch has no rows.  Storage stays at two copies and a replayed batch
  rewrites the same slot (idempotent).
* ``update`` -- ``foreachBatch`` writes each batch's changed rows to a ring of
  slots; every ``COMPACT_EVERY`` batches the newest row per key is folded into
  a base table (two slots again), so neither storage nor a read grows with the
  number of batches.

Every query has an explicit ``checkpointLocation`` under the same folder, so a
restarted job resumes from its offsets and state.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tessera.session import scratch_path

BATCH_COL = "_batch_id"
SLOT_COL = "_slot"
COMPACT_EVERY = 10
_POLL_S = 0.2


class _Reports(StreamingQueryListener):
    """Every batch's report of the queries that this module started, also of those that nobody polls.

    Spark itself keeps the last hundred.  A report is held as its figures, one short row per batch.
    """

    def __init__(self) -> None:
        self.by_run: dict[str, dict[int, dict]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        held = self.by_run.get(str(event.progress.runId))
        if held is not None:
            _keep(held, json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def _keep(held: dict[int, dict], p: dict) -> None:
    # An idle trigger reports the next batch with no rows before that batch runs.
    batch = int(p["batchId"])
    if batch not in held or p.get("numInputRows", 0) or not held[batch].get("numInputRows", 0):
        held[batch] = {k: p.get(k) for k in ("batchId", "numInputRows", "inputRowsPerSecond", "processedRowsPerSecond", "durationMs",
                                             "eventTime", "stateOperators")}


_LISTENERS: dict[int, _Reports] = {}


def _listener(spark: SparkSession) -> _Reports:
    if id(spark) not in _LISTENERS:
        _LISTENERS[id(spark)] = _Reports()
        spark.streams.addListener(_LISTENERS[id(spark)])
    return _LISTENERS[id(spark)]


@dataclass
class StreamRun:
    """A streaming query: where it leaves its output, its order, and all its progress reports."""

    spark: SparkSession
    path: str
    mode: str
    keys: Sequence[str] = ()
    order: Sequence[Column] = ()
    query: StreamingQuery | None = None
    reports: dict = field(default_factory=dict)

    @property
    def progress(self) -> list:
        """Every batch's latest report, in batch order."""
        self.poll()
        return [self.reports[b] for b in sorted(self.reports)]

    def poll(self) -> None:
        """The listener hears of a batch a little later than the query itself, which knows its last hundred."""
        for p in (self.query.recentProgress if self.query is not None else ()):
            _keep(self.reports, json.loads(p.json))

    def wait(self, timeout_s: float | None = None) -> bool:
        """Until the query ends by itself; False if it still runs after ``timeout_s``."""
        end = None if timeout_s is None else time.monotonic() + timeout_s
        while self.query.isActive:
            self.poll()
            left = _POLL_S if end is None else min(_POLL_S, end - time.monotonic())
            if left <= 0:
                return False
            self.query.awaitTermination(left)
        self.poll()
        self.check()
        return True

    def check(self) -> None:
        if self.query is not None and self.query.exception() is not None:
            raise RuntimeError(f"stream {self.query.name} failed: {self.query.exception()}")

    def stop(self) -> None:
        self.poll()
        if self.query is not None and self.query.isActive:
            self.query.stop()

    def result(self) -> DataFrame:
        """The current result, in the query's order if it has one."""
        out = read_snapshot(self.spark, self.path, self.mode, self.keys)
        return out.orderBy(*self.order) if self.order else out

    def delete(self) -> None:
        """Remove the query's output and checkpoint (its results can no longer be read)."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def _write_slot(rows: DataFrame, folder: str, slot: int, batch_id: int) -> None:
    """Overwrite one slot, then its record: a reader only follows records of finished writes."""
    rows.write.mode("overwrite").parquet(f"{folder}/data/{SLOT_COL}={slot}")
    (rows.sparkSession.createDataFrame([(batch_id,)], f"{BATCH_COL} long").coalesce(1)
     .write.mode("overwrite").parquet(f"{folder}/slots/{SLOT_COL}={slot}"))


def _newest_slot(spark: SparkSession, folder: str, before: int | None = None):
    """(slot, batch id) of the newest finished write, or None."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/slots")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    slots = spark.read.parquet(f"{folder}/slots")
    if before is not None:
        slots = slots.filter(F.col(BATCH_COL) < before)
    row = slots.orderBy(F.desc(BATCH_COL)).first()
    return None if row is None else (row[SLOT_COL], row[BATCH_COL])


def _read_slot(spark: SparkSession, folder: str, slot: int) -> DataFrame:
    return spark.read.parquet(f"{folder}/data/{SLOT_COL}={slot}")


def _newest_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For each key the row of its latest batch, with the batch id."""
    rest = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), BATCH_COL).alias("__row")
    return rows.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])


def _update_rows(spark: SparkSession, out: str, keys: Sequence[str], until: int | None = None, before: int | None = None) -> DataFrame:
    """The base table and the changes since, reduced to the newest row per key."""
    base = _newest_slot(spark, f"{out}/base", before)
    changes = spark.read.parquet(f"{out}/log").drop(SLOT_COL).filter(F.col(BATCH_COL) > (base[1] if base else -1))
    if until is not None:
        changes = changes.filter(F.col(BATCH_COL) <= until)
    rows = changes if base is None else changes.unionByName(_read_slot(spark, f"{out}/base", base[0]))
    return _newest_rows(rows, keys)


def _batch_writer(out: str, mode: str, keys: Sequence[str], transform: Callable[[DataFrame], DataFrame] | None):
    def write(batch: DataFrame, batch_id: int) -> None:
        # A transform may use the batch more than once (its mean, its rows): compute it once.
        held = batch.persist() if transform else batch
        try:
            result = transform(held) if transform else held
            if mode == "complete":
                _write_slot(result, out, batch_id % 2, batch_id)
                return
            # Twice as many slots as a compaction covers: none is reused before it is in the base table.
            slot = batch_id % (2 * COMPACT_EVERY)
            result.withColumn(BATCH_COL, F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{out}/log/{SLOT_COL}={slot}")
            if (batch_id + 1) % COMPACT_EVERY == 0:
                folded = _update_rows(batch.sparkSession, out, keys, until=batch_id, before=batch_id)
                _write_slot(folded, f"{out}/base", (batch_id + 1) // COMPACT_EVERY % 2, batch_id)
        finally:
            if transform:
                held.unpersist()
    return write


def start_stream(df: DataFrame, mode: str, name: str, keys: Sequence[str] = (), trigger: dict | None = None,
                 out: str | None = None, batch_transform: Callable[[DataFrame], DataFrame] | None = None,
                 order: Sequence[Column] = ()) -> StreamRun:
    """Start ``df`` with ``outputMode(mode)`` and leave it running.

    ``trigger`` defaults to ``availableNow`` (process everything present, then end);
    ``{"processingTime": "15 seconds"}`` runs until ``StreamRun.stop``.  ``result()`` may be
    read while it runs.  ``batch_transform`` (complete/update modes) is a batch DataFrame
    function applied to every micro-batch result before it is written -- e.g. flag the
    windows above the batch's mean count (W12).  ``order`` sorts what ``result()`` returns.
    """
    spark = df.sparkSession
    out = out or scratch_path(spark, name)
    if mode == "append" and batch_transform is not None:
        raise ValueError("batch_transform needs complete or update mode")
    if mode == "update" and not keys:
        raise ValueError("update mode needs the key columns")
    listener = _listener(spark)
    writer = (df.writeStream.outputMode(mode).option("checkpointLocation", f"{out}/_checkpoint")
              .queryName(f"{name}_{abs(hash(out)) % 10**8}").trigger(**(trigger or {"availableNow": True})))
    if mode == "append":
        writer = writer.format("parquet").option("path", f"{out}/data")
    else:
        writer = writer.foreachBatch(_batch_writer(out, mode, tuple(keys), batch_transform))
    query = writer.start()
    reports = listener.by_run.setdefault(str(query.runId), {})
    return StreamRun(spark, out, mode, tuple(keys), tuple(order), query, reports)


def run_stream(df: DataFrame, mode: str, name: str, keys: Sequence[str] = (), trigger: dict | None = None,
               timeout_s: float | None = None, out: str | None = None,
               batch_transform: Callable[[DataFrame], DataFrame] | None = None, order: Sequence[Column] = ()) -> StreamRun:
    """Start a query (see ``start_stream``), wait until its present input is drained, stop it.

    With ``timeout_s`` a query that is not done by then is stopped and ``TimeoutError`` raised:
    a partial result is never returned as the result.  Its checkpoint stays, so the same
    ``out`` resumes it.
    """
    run = start_stream(df, mode, name, keys, trigger, out, batch_transform, order)
    try:
        if trigger is None or "availableNow" in trigger or "once" in trigger:
            if not run.wait(timeout_s):
                raise TimeoutError(f"stream {name} was not done after {timeout_s} s; its output in {run.path} is incomplete")
        else:
            end = None if timeout_s is None else time.monotonic() + timeout_s
            # A drained trigger reports no new rows while the query waits for the next.
            while run.query.isActive and (run.query.status["isDataAvailable"] or run.query.status["isTriggerActive"]
                                          or run.query.lastProgress is None):
                run.poll()
                if end is not None and time.monotonic() > end:
                    raise TimeoutError(f"stream {name} was not drained after {timeout_s} s; its output in {run.path} is incomplete")
                time.sleep(_POLL_S)
            if run.query.isActive and timeout_s is None:
                run.query.processAllAvailable()
    finally:
        run.stop()
    run.check()
    return run


def read_snapshot(spark: SparkSession, out: str, mode: str, keys: Sequence[str] = ()) -> DataFrame:
    """The query's current result table.

    * append: every emitted row;
    * complete: the table of the last batch, empty if that batch has no rows;
    * update: for each key, the row from the latest batch that updated it.
    """
    if mode == "append":
        return spark.read.parquet(f"{out}/data")
    if mode == "complete":
        newest = _newest_slot(spark, out)
        if newest is None:
            raise ValueError(f"no batch of the query in {out} is finished")
        return _read_slot(spark, out, newest[0])
    if mode == "update":
        if not keys:
            raise ValueError("update-mode snapshots need the key columns")
        return _update_rows(spark, out, keys).drop(BATCH_COL)
    raise ValueError(f"unknown output mode {mode!r}")


def preview_stream(df: DataFrame, n: int, name: str, timeout_s: float | None = None) -> DataFrame:
    """K6: the first ``n`` rows that a stream brings, in append mode; the query ends by itself when its input is drained.

    The cap is Spark's streaming limit: its count is kept in the checkpoint, so later batches and a
    restart add nothing.
    """
    return run_stream(df.limit(n), "append", name, timeout_s=timeout_s).result()


def progress_frame(spark: SparkSession, run: StreamRun) -> DataFrame:
    """One row per micro-batch with its id, input rows, durations, watermark, and the figures of its state operators."""
    def state(p: dict, figure: str) -> int:
        return sum(int(op.get(figure) or 0) for op in p.get("stateOperators") or [])

    rows = [(int(p["batchId"]), int(p.get("numInputRows") or 0),
             float(p.get("inputRowsPerSecond") or 0.0), float(p.get("processedRowsPerSecond") or 0.0),
             int((p.get("durationMs") or {}).get("triggerExecution", 0)), (p.get("eventTime") or {}).get("watermark"),
             state(p, "numRowsTotal"), state(p, "numRowsDroppedByWatermark"))
            for p in run.progress]
    return spark.createDataFrame(
        rows, "batch_id long, num_input_rows long, input_rows_per_second double, "
              "processed_rows_per_second double, trigger_ms long, watermark string, state_rows long, dropped_rows long")
