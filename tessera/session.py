"""Session defaults and the shared scratch location.

Every operator in the library is a pure ``DataFrame -> DataFrame`` function, so the
only session state the library cares about is:

* ``spark.sql.session.timeZone`` pinned to UTC, so calendar functions, epoch
  conversions and event-time windows do not depend on the machine's zone;
* the shared checkpoint folder (``spark.checkpoint.dir``) used to cut lineage in
  iterative jobs and to hold streaming checkpoints / snapshot tables.  The cluster
  names it; we only fall back to a fresh local folder when it is unset (tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, app_name: str = "tessera",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's defaults.

    AQE is on so shuffle partition counts coalesce at run time and skewed join
    partitions are split; the UI is off (no server is started).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input on ``total_cores`` cores.

    Scan splits and shuffle partitions are sized to ~``target_partition_bytes``
    so each task's share fits executor memory without spilling at any scale;
    the initial shuffle partition count is an upper bound that AQE coalesces
    down at run time (and splits further for skewed joins).  E.g. 100 TB on
    4,000 cores: ~400k scan splits and as many initial shuffle partitions.
    """
    partitions = max(3 * total_cores, input_bytes // target_partition_bytes)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(int(partitions)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def ensure_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone to UTC (idempotent)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Read from ``spark.checkpoint.dir`` (or the SparkContext's checkpoint dir);
    only when neither is set (local tests) a fresh folder is created and
    registered, so RDD/DataFrame ``checkpoint()`` and our streaming checkpoints
    land in the same place.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- no SparkContext (e.g. a Connect session)
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    root = spark.conf.get(_CHECKPOINT_KEY, None)
    if not root and sc is not None:
        root = sc.getConf().get(_CHECKPOINT_KEY, None)
    if not root:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not str(master).startswith("local"):
            raise RuntimeError(
                f"{_CHECKPOINT_KEY} is not set: a cluster job needs a shared checkpoint folder "
                "(a local temporary folder is not visible to other executors)")
        # Unset in a local session (tests): a fresh local folder.
        root = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set(_CHECKPOINT_KEY, root)
    if sc is not None:
        sc.setCheckpointDir(root)
        return sc.getCheckpointDir() or root
    return root


_GIVEN: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique sub-folder of the shared checkpoint folder for one job/run."""
    root = checkpoint_root(spark).rstrip("/")
    _GIVEN.append(f"{root}/{name}-{uuid.uuid4().hex[:12]}")
    return _GIVEN[-1]


def delete_scratch(spark: SparkSession) -> int:
    """Delete the folders that ``scratch_path`` has given out in this process; their results can no longer be read.

    For callers that are done with what they asked for.  Returns the number of folders that were there.
    """
    deleted = 0
    while _GIVEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(_GIVEN.pop())
        deleted += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return deleted


__all__ = ["build_session", "scale_conf", "ensure_utc", "checkpoint_root", "scratch_path", "delete_scratch"]
