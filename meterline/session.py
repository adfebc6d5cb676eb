"""Session construction and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# SQL settings the library relies on for right results or for scale. All can be changed at run time.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app: str = "meterline", master: str | None = None, settings: dict[str, str] | None = None) -> SparkSession:
    """Create a session. On a cluster leave ``master`` unset and let spark-submit provide it."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    merged = {"spark.ui.enabled": "false", **SQL_SETTINGS, **(settings or {})}
    for key, value in merged.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_settings(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings to a session somebody else created."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def _sibling(spark: SparkSession) -> SparkSession:
    """A session of its own SQL settings over the same catalog, with the library's and the number of shuffle partitions."""
    sibling = pin_settings(spark.newSession())
    sibling.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    return sibling


def planning_session(spark: SparkSession) -> SparkSession:
    """A sibling session that plans joins by the catalog's statistics.

    Inner joins are ordered by estimated sizes in place of the order they were written in. ``ANALYZE`` stores
    histograms here, so that ranges are estimated on skewed columns, too. Times without a zone are read as times
    of the session's zone, as Spark's estimate of a filter fails on an analyzed zone-less column.
    """
    sibling = _sibling(spark)
    for name in ("cbo.enabled", "cbo.joinReorder.enabled", "statistics.histogram.enabled"):
        sibling.conf.set(f"spark.sql.{name}", "true")
    sibling.conf.set("spark.sql.parquet.inferTimestampNTZ.enabled", "false")
    return sibling


def streaming_session(spark: SparkSession) -> SparkSession:
    """A sibling session with its own SQL settings for stateful streaming.

    RocksDB keeps window state off the executor heap. Session windows are merged inside each map
    task before the shuffle, so a hot key sends partial sessions, not its raw rows.
    """
    sibling = _sibling(spark)
    sibling.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    sibling.conf.set("spark.sql.sessionWindow.merge.sessions.in.local.partition", "true")
    return sibling


def apart_session(spark: SparkSession) -> SparkSession:
    """A sibling session with the same settings, in which a union keeps the partitions of its parts.

    Spark otherwise makes one partition of parts that have one each.
    """
    sibling = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            sibling.conf.set(key, value)
    sibling.conf.set("spark.sql.unionOutputPartitioning", "false")
    return sibling


_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named in ``spark.checkpoint.dir``.

    Where the setting is absent a local folder is made, which is only right in local mode.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _LOCAL_ROOTS:
        root = tempfile.mkdtemp(prefix="meterline-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        _LOCAL_ROOTS[context.applicationId] = root
    return _LOCAL_ROOTS[context.applicationId]


_MADE: dict[str, list[str]] = {}


def run_dir(spark: SparkSession, label: str) -> str:
    """A new, never reused path under the shared root; ``release`` deletes it."""
    path = os.path.join(shared_root(spark), f"{label}-{uuid.uuid4().hex}")
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete the folders that ``run_dir`` has handed out to this application, wherever they are; returns how many existed.

    For the end of an application, when no result that reads them is in use any more.
    """
    context = spark.sparkContext
    gone = 0
    for path in _MADE.pop(context.applicationId, []):
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        gone += place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
    return gone
