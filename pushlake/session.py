"""Session helpers.

The library never changes session settings on a session it did not create.
``local_session`` is for tests and the bench only. ``scratch_path`` puts
intermediate tables under the shared folder the cluster names in
``spark.checkpoint.dir``; only when that is unset (a laptop test) does it
pick a fresh temporary folder and register it as the checkpoint dir.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "pushlake") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; set one only where unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        # getCheckpointDir() is <configured dir>/<application uuid>; keep the app folder
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        # a local session (tests): a fresh temporary folder is shared by definition
        configured = tempfile.mkdtemp(prefix="pushlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint root for a written table."""
    return os.path.join(checkpoint_root(spark), "scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def _path_and_fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path_and_fs(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the library's own (a replaced batch or a dropped segment)."""
    p, fs = _path_and_fs(spark, path)
    fs.delete(p, True)
