"""Session helpers: a local session for tests/bench, and the shared work folder.

On a cluster the session comes from the caller; we only *read* its
``spark.checkpoint.dir`` and put every materialised table under it, so a lost
executor never loses data that lived on a machine-local disk.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
from collections.abc import Iterator

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = 8, shuffle_partitions: int = 8,
                  app: str = "docketline") -> SparkSession:
    """Local session for tests and the bench (UI off, UTC, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("DOCKETLINE_DRIVER_MEM", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; set a scratch one only if unset.

    A cluster names a shared folder in ``spark.checkpoint.dir``; we never
    override it. Where nothing is configured a local session gets a fresh temporary
    folder; a cluster session raises, since that folder would be on one machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get(_CHECKPOINT_KEY, None) or spark.conf.get(_CHECKPOINT_KEY, None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="docketline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def work_dir(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder, for written tables of this session."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "docketline", *parts])


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that are made and run inside give back the disk of their shuffles when they end. Else it stays taken
    until the driver's JVM happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


# ---- the file system behind a path (any that Hadoop knows)

def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders and files directly under ``path``; none if it does not exist."""
    fs, p = _hadoop(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def complete_children(spark: SparkSession, path: str) -> list[str]:
    """Folders under ``path`` whose write was committed."""
    return sorted(n for n in child_names(spark, path) if path_exists(spark, f"{path}/{n}/_SUCCESS"))


def path_stamp(spark: SparkSession, path: str) -> str:
    """Size, file count and modification time of a file or folder, as text."""
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return "absent"
    c = fs.getContentSummary(p)
    return f"{c.getLength()}:{c.getFileCount()}:{fs.getFileStatus(p).getModificationTime()}"


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Summed length of the files under ``path``."""
    fs, p = _hadoop(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)
