"""Versioned feature snapshots on plain Parquet.

A table is a set of parts, and a part is a folder of Parquet files: a whole table, or the
rows of one date or one batch. A version is a directory ``v=NNNNNN`` with the folders that it
wrote and a manifest of all folders that it consists of; those of parts that did not change
belong to earlier versions. So a version costs what it changes, and a reader that has the
manifest sees one state. A version counts once its marker file exists, which is written
last: a job that dies half way leaves the previous version current.

The manifest also lists the batches in the version (a date, or a streaming query with its
last batch) with a mark of each, so whether a batch is applied is asked of the current
version alone. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from marketloom.sources import listing

MARKER = "COMMITTED"
MANIFEST = "manifest"
KEPT_VERSIONS = 3  # readers of an older version finish before it goes
WHOLE = "all"
BATCHES = ""  # the manifest's table name for its batches


@dataclass(frozen=True)
class Version:
    """What a version consists of: mark by batch, and folder by table and part."""

    number: int = 0
    batches: dict[str, str] = field(default_factory=dict)
    parts: dict[str, dict[str, str]] = field(default_factory=dict)


def _folder(number: int) -> str:
    return f"v={number:06d}"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n[2:]) for n in listing.list_names(spark, root) if n.startswith("v="))


def _versions(spark: SparkSession, root: str) -> list[int]:
    return [n for n in _numbers(spark, root) if listing.exists(spark, f"{root}/{_folder(n)}/{MARKER}")]


def current_version(spark: SparkSession, root: str) -> int | None:
    return max(_versions(spark, root), default=None)


def read_version(spark: SparkSession, root: str, number: int) -> Version:
    rows = spark.read.schema("name STRING, part STRING, value STRING").json(f"{root}/{_folder(number)}/{MANIFEST}").collect()
    parts: dict[str, dict[str, str]] = {}
    for name, part, value in rows:
        parts.setdefault(name, {})[part] = value
    return Version(number, parts.pop(BATCHES, {}), parts)


def current(spark: SparkSession, root: str) -> Version:
    """The current version; an empty one with number 0 before the first commit."""
    number = current_version(spark, root)
    return Version() if number is None else read_version(spark, root, number)


def held_batches(spark: SparkSession, root: str) -> dict[str, str]:
    """Batch to mark, of the current version: one entry per date and per streaming query."""
    return current(spark, root).batches


def read_parts(spark: SparkSession, root: str, folders: Iterable[str], schema: T.StructType) -> DataFrame:
    """The rows of some parts; no part, no rows."""
    paths = [f"{root}/{f}" for f in sorted(set(folders))]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def load_snapshot(spark: SparkSession, root: str, name: str, schema: T.StructType, version: Version | None = None) -> DataFrame:
    """A table of a version (default: the current one), or an empty frame before the first commit. Read errors are not swallowed."""
    version = version or current(spark, root)
    if not version.number:
        return spark.createDataFrame([], schema)
    if name not in version.parts:
        raise FileNotFoundError(f"{name} is not in version {version.number} of {root}")
    return read_parts(spark, root, version.parts[name].values(), schema)


def next_folder(spark: SparkSession, root: str) -> str:
    """The folder, below ``root``, for what the next version writes; one that a dead job used is not taken again."""
    return _folder(max(_numbers(spark, root), default=0) + 1)


def commit(spark: SparkSession, root: str, folder: str, parts: dict[str, dict[str, str]], batches: dict[str, str], keep: int | None = KEPT_VERSIONS) -> int:
    """Make ``folder`` a version of these parts and batches, and drop what no kept version holds (``keep`` None: all are kept)."""
    rows = [(BATCHES, b, m) for b, m in batches.items()]
    # a table without parts is there, and empty
    rows += [(name, part, where) for name, own in parts.items() for part, where in own.items()]
    spark.createDataFrame(sorted(rows), "name STRING, part STRING, value STRING").coalesce(1).write.json(f"{root}/{folder}/{MANIFEST}")
    listing.touch(spark, f"{root}/{folder}/{MARKER}")
    if keep:
        _clean(spark, root, keep)
    return int(folder[2:])


def save_snapshots(spark: SparkSession, root: str, tables: dict[str, DataFrame], batches: dict[str, str], keep: int | None = KEPT_VERSIONS) -> int:
    """Write whole tables as a new version that holds ``batches`` and commit it.

    Never writes where it reads: the new version may be computed from the old one.
    """
    folder = next_folder(spark, root)
    for name, df in tables.items():
        df.write.parquet(f"{root}/{folder}/{name}")
    return commit(spark, root, folder, {name: {WHOLE: f"{folder}/{name}"} for name in tables}, batches, keep)


def history(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """The rows of a table in all versions that are there, one after the other."""
    found = [read_version(spark, root, n).parts.get(name, {}) for n in _versions(spark, root)]
    return read_parts(spark, root, {f for own in found for f in own.values()}, schema)


def write_by(df: DataFrame, root: str, folder: str, name: str, by: str) -> dict[str, str]:
    """Write one folder per value of the text column ``by``: part to folder, from the listing.

    The rebalance hint sizes the files and splits a value with most of the rows over several tasks.
    """
    spark, where = df.sparkSession, f"{folder}/{name}"
    df.hint("rebalance", by).write.partitionBy(by).parquet(f"{root}/{where}")
    return {v: f"{where}/{by}={v}" for v in listing.partition_values(spark, f"{root}/{where}", by)}


def _clean(spark: SparkSession, root: str, keep: int) -> None:
    """Remove versions that are no longer kept, except for folders that a kept one consists of."""
    kept = _versions(spark, root)[-keep:]
    held = {f for n in kept for own in read_version(spark, root, n).parts.values() for f in own.values()}
    for number in _numbers(spark, root):
        if number >= kept[-1] or number in kept:
            continue
        own = _folder(number)
        _prune(spark, root, own, {f for f in held if f.startswith(f"{own}/")})


def _prune(spark: SparkSession, root: str, folder: str, held: set[str]) -> None:
    if not held:
        listing.remove(spark, f"{root}/{folder}")
        return
    # the marker goes first: without it the folder is no version
    names = sorted(listing.list_names(spark, f"{root}/{folder}"), key=lambda n: n != MARKER)
    for name in names:
        path = f"{folder}/{name}"
        if path not in held:
            _prune(spark, root, path, {f for f in held if f.startswith(f"{path}/")})
