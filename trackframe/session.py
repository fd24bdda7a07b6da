"""Session-level helpers: the shared scratch folder and staged tables.

The library never owns the session. It reads the cluster's shared checkpoint
folder (``spark.checkpoint.dir``) for anything it has to write in between, and only
sets one itself when none is configured (local runs and tests).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Uses the session's checkpoint folder (``spark.checkpoint.dir``). Only a
    local-mode session without one gets a private temporary folder; on a
    cluster a machine-local folder would not survive executor loss, so an
    unset checkpoint folder is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="trackframe-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster (e.g. on HDFS or S3)")
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path under the shared folder."""
    return f"{shared_dir(spark)}/trackframe-{label}-{uuid.uuid4().hex[:12]}"


def hadoop_path(spark: SparkSession, path: str):
    """``(path, file system)`` of the path's scheme, as the JVM has them."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(sc._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if ``path`` exists (Hadoop FileSystem of its scheme).

    Where the JVM file system is not reachable from Python (Spark Connect)
    this answers True and callers fall back to trying a read.
    """
    try:
        p, fs = hadoop_path(spark, path)
        return bool(fs.exists(p))
    except Exception:  # noqa: BLE001
        return True


def drop_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete a folder this library staged (Hadoop FileSystem of the path's scheme).

    Returns False where the JVM file system is not reachable from Python
    (e.g. Spark Connect); the folder then stays for the operator to clear.
    """
    try:
        p, fs = hadoop_path(spark, path)
        return bool(fs.delete(p, True))
    except Exception:  # noqa: BLE001 - best effort clean-up only
        return False


@contextmanager
def staged_copy(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Write ``df`` once as parquet under the shared folder; yield a frame over it; delete it on exit.

    For intermediate results that must not be recomputed (or must not
    read files that are about to be replaced): parquet is columnar and
    compressed, survives executor loss like a checkpoint, carries byte statistics
    for the planner, and is removed as soon as the caller's write has committed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        drop_path(spark, path)
