"""Directory listings on whatever file system a path lives on."""

from __future__ import annotations

import hashlib
import re
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; an absent path has none."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def has_files(spark: SparkSession, path: str, suffix: str) -> bool:
    """Whether a data file with this ending lies anywhere below ``path``."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return False
    found = fs.listFiles(target, True)
    while found.hasNext():
        name = found.next().getPath().getName()
        if name.endswith(suffix) and not name.startswith(("_", ".")):
            return True
    return False


def first_lines(spark: SparkSession, paths: list[str], at_once: int = 16) -> list[str | None]:
    """The first line of each text file; None for an empty one. Opens the files, reads no further."""

    def first(path: str) -> str | None:
        fs, target = _fs(spark, path)
        jvm = spark._jvm
        stream = fs.open(target)
        try:
            return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"), 1024).readLine()
        finally:
            stream.close()

    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(first, paths))


def fingerprint(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of the files directly below ``path``, as one short text."""
    fs, target = _fs(spark, path)
    found = sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(target)) if fs.exists(target) else []
    return hashlib.sha256(repr(found).encode()).hexdigest()[:32]


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty marker file; fails if it exists."""
    fs, target = _fs(spark, path)
    fs.create(target, False).close()


def rename(spark: SparkSession, path: str, to: str) -> None:
    fs, target = _fs(spark, path)
    if not fs.rename(target, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"cannot rename {path} to {to}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it."""
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def partition_values(spark: SparkSession, root: str, key: str) -> list[str]:
    return [
        n.split("=", 1)[1] for n in list_names(spark, root) if re.match(f"^{re.escape(key)}=", n)
    ]


def latest_partition(spark: SparkSession, root: str, key: str = "ingestion_date") -> str:
    """Newest ``key=YYYYMMDD`` value. No partition, or a malformed name, is an error."""
    values = partition_values(spark, root, key)
    if not values:
        raise FileNotFoundError(f"no {key} partitions below {root}")
    return max(values, key=lambda v: datetime.strptime(v, "%Y%m%d"))
