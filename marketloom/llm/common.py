"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import gc
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.session import use_utc

# words of every operator whose contract speaks of words (fixed value)
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"


def share_code(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package where the driver found it (elsewhere it is installed)."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(p for p in (known, root) if p)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(share_code(spark)).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A key that any recomputation finds again: rows with equal id and text share it.

    Rows that agree in both are the same document twice and get the same answer, so
    sharing a key is harmless; rows that only share an id stay apart.
    """
    mark = F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)
    null_text = F.when(F.col(text_col).isNull(), F.lit("0")).otherwise(F.lit("1"))
    return F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), null_text, mark)


def wrapped(docs: DataFrame, **needed: Column) -> DataFrame:
    """The rows as one column ``row`` beside working columns, which no column of the input can clash with."""
    whole = F.struct(*(F.col(_quoted(c)).alias(f"c{i}") for i, c in enumerate(docs.columns)))
    return docs.select(whole.alias("row"), *(c.alias(n) for n, c in needed.items()))


def unwrapped(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The rows of ``wrapped`` with the columns of ``docs`` again."""
    return rows.select(*(F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def spread(spark: SparkSession, tasks_per_slot: int = 3) -> int:
    """Partitions for compute-bound stages: a fixed number would not follow the cluster."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), tasks_per_slot * spark.sparkContext.defaultParallelism)


def forget(spark: SparkSession) -> None:
    """Let go of shuffle files whose tables have been written; Spark deletes them once their plans are garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
