"""Shared storage locations for intermediate tables and stream checkpoints.

Intermediate data goes under the cluster's checkpoint directory
(``spark.checkpoint.dir``), which on a cluster names shared storage that all
executors and a restarted driver can reach. A directory of our own is set
only when the session has none (local runs and tests).

File-system checks go through Hadoop's ``FileSystem`` API when the session
runs in this process (classic PySpark); a Spark Connect session has no local
JVM, so only local paths can be checked there.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def _context(spark: SparkSession):
    """The SparkContext of a classic session, None for Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect: no driver-side context
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """The session's checkpoint directory, set to a fresh local one if unset.

    A directory named in the session configuration is also made the
    context's checkpoint directory when the context has none yet, so that
    ``DataFrame.checkpoint()`` writes there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        if sc is not None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="ohlcflow-ckpt-")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the checkpoint root (not created)."""
    return f"{checkpoint_root(spark)}/ohlcflow/{name}-{uuid.uuid4().hex[:12]}"


def _hadoop_path(spark: SparkSession, path: str):
    sc = _context(spark)
    if sc is None:
        return None, None
    hp = sc._jvm.org.apache.hadoop.fs.Path(path)
    return hp, hp.getFileSystem(sc._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system API (any scheme)."""
    hp, fs = _hadoop_path(spark, path)
    if fs is None:
        return os.path.exists(path.removeprefix("file:"))
    return bool(fs.exists(hp))


def qualified_path(spark: SparkSession, path: str) -> str:
    """``path`` fully qualified by its file system (``file:/...``, ``s3a://...``)."""
    hp, fs = _hadoop_path(spark, path)
    if fs is None:
        return path if "://" in path or path.startswith("file:") else "file:" + os.path.abspath(path)
    return fs.makeQualified(hp).toString()


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder of our own, if it is there (any scheme)."""
    hp, fs = _hadoop_path(spark, path)
    if fs is None:
        shutil.rmtree(path.removeprefix("file:"), ignore_errors=True)
    else:
        fs.delete(hp, True)


def move_path(spark: SparkSession, path: str, to: str) -> None:
    """Moves a file or folder of our own to ``to``, in place of what is there (any scheme)."""
    remove_path(spark, to)
    hp, fs = _hadoop_path(spark, path)
    if fs is None:
        os.makedirs(os.path.dirname(to.removeprefix("file:")), exist_ok=True)
        os.rename(path.removeprefix("file:"), to.removeprefix("file:"))
        return
    target, _ = _hadoop_path(spark, to)
    fs.mkdirs(target.getParent())
    if not fs.rename(hp, target):
        raise OSError(f"cannot move {path} to {to}")
