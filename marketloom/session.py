"""Session set-up and the shared scratch area used to cut lineage."""

from __future__ import annotations

import atexit
import contextlib
import os
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_scratch_paths: list[str] = []
_local_scratch: tempfile.TemporaryDirectory | None = None


def build_session(app: str = "marketloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on. ``conf`` uses ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # call-site capture costs more than planning when expressions are built in loops
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Results are defined in UTC whatever zone the caller's session has; workers find this package where the driver found it."""
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(p for p in (known, root) if p)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only where all is one process."""
    global _local_scratch
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_scratch is None:
        _local_scratch = tempfile.TemporaryDirectory(prefix="marketloom-", ignore_cleanup_errors=True)
    return _local_scratch.name


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the scratch folder; what is in it goes when the driver's process ends."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    if not _scratch_paths:
        atexit.register(remove_scratch, spark)
    _scratch_paths.append(path)
    return path


def remove_scratch(spark: SparkSession) -> None:
    """Delete all that this process has written below the scratch folder; frames that read it can no longer be used."""
    while _scratch_paths:
        # a file system that is gone must not keep the process from ending
        with contextlib.suppress(Exception):
            target = spark._jvm.org.apache.hadoop.fs.Path(_scratch_paths.pop())
            target.getFileSystem(spark._jvm.org.apache.hadoop.conf.Configuration()).delete(target, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a scan of the copy.

    Cuts the lineage like a reliable checkpoint, survives lost executors, and
    keeps column pruning and size statistics for the plans that read it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def python_partitions(spark: SparkSession, units: int = 0, per_task: int = 1) -> int:
    """Partition count for compute-bound Python work: sized by the work, not by its few bytes.

    Adaptive execution would otherwise merge small inputs into one task.
    """
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(floor, -(-units // per_task))
