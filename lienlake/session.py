"""Spark session and storage-location helpers.

The session settings are the ones that matter at cluster scale: adaptive
execution (runtime coalescing, skew-join splitting, runtime broadcast
conversion on *measured* shuffle sizes), a shuffle partition count sized by
the caller, and Arrow for the few pandas-backed steps.

Storage: every table this package writes lives under one shared root.  The
root is read from the session (``spark.lienlake.lakeRoot``); when unset it is
``<spark.checkpoint.dir>/lienlake``.  Only when *neither* is set (local tests)
do we create a scratch directory and register it as the checkpoint dir.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

LAKE_ROOT_CONF = "spark.lienlake.lakeRoot"

# Defaults for a cluster session.  Shuffle partitions is deliberately a
# parameter: ~128-256 MB of shuffle data per partition is the target; AQE
# coalesces small ones at runtime.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Runtime (measured) broadcast conversion; static planning threshold is
    # left at Spark's default 10 MB estimate.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "lienlake", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(CLUSTER_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir, setting a scratch one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir (or spark.lienlake.lakeRoot) to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="lienlake-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def lake_root(spark: SparkSession) -> str:
    root = spark.conf.get(LAKE_ROOT_CONF, None)
    if root:
        return root.rstrip("/")
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    root = base.rstrip("/") + "/lienlake"
    spark.conf.set(LAKE_ROOT_CONF, root)
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique location under the shared lake root (never machine-local
    unless the session itself points the lake there)."""
    return "/".join([lake_root(spark), "scratch", uuid.uuid4().hex, *parts])


def local_path(path: str) -> str | None:
    """Strip a file: scheme; None for remote filesystems."""
    if path.startswith("file:"):
        return path[len("file:"):]
    if "://" in path:
        return None
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Filesystem-agnostic existence check through Hadoop's FileSystem API."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file or folder, from the file system's own listing."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(hpath).getLength()


def remove_dir(spark: SparkSession, path: str) -> None:
    """Remove a directory of this package's own tables."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def move_dir(spark: SparkSession, source: str, target: str) -> None:
    """Rename a directory of this package's own tables; what stands at the target is replaced."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    old, new = path(source), path(target)
    fs = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(new.getParent())
    fs.delete(new, True)
    if not fs.rename(old, new):
        raise OSError(f"{source} can't be moved to {target}")


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory())


__all__ = ["build_session", "ensure_checkpoint_dir", "lake_root", "scratch_path",
           "path_exists", "list_dirs", "move_dir", "remove_dir", "stored_bytes", "local_path"]
