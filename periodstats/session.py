"""Session helpers: a local session for tests and the shared folder for materialised data.

Durable intermediate data (layer tables, checkpoints, landed files) goes below the folder the
cluster names in ``spark.checkpoint.dir``. A local run without that setting gets a fresh
scratch folder; a cluster run without it is refused, because a machine-local folder does not
survive the loss of an executor.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "periodstats") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors; also installed as the RDD checkpoint folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        # local-cluster has executors of its own, which share no folder of the driver
        if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="periodstats-ckpt-")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    path = f"{shared_dir(spark)}/periodstats/{name}-{uuid.uuid4().hex[:12]}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


#: Paths given out by ``scratch_path``, by application.
_MADE: dict[str, list[str]] = {}


def clear_scratch(spark: SparkSession) -> int:
    """Remove what this application has written to paths of ``scratch_path``; their number.

    For a caller that has written its results elsewhere: frames that read intermediates, and
    warehouses in the scratch folder, cannot be read afterwards."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    made = _MADE.pop(spark.sparkContext.applicationId, [])
    return sum(bool(make(p).getFileSystem(conf).delete(make(p), True)) for p in made)


def as_local_path(path: str) -> str:
    """Strip a ``file:`` scheme for the few driver-side file checks done on local runs."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.normpath(path)
