"""The ledger of training runs: an append-only table and the selections on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions import scalars as S
from marketloom.schemas import RUNS

# fixed values: names the reports use
BEST_METRIC = "content_hit_rate_50"
SHOWN = {
    "svd_hit_rate": "svd_hit_rate_50",
    "cb_hit_rate": "content_hit_rate_50",
    "svd_precision": "svd_precision_50",
    "cb_precision": "content_precision_50",
}


def append_runs(runs: DataFrame, path: str) -> None:
    runs.select(*RUNS.fieldNames()).write.mode("append").parquet(path)


def scan_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(path)


def metric(name: str):
    return F.col("metrics")[f"metrics.{name}"]


def param(name: str):
    return F.col("params")[f"params.{name}"]


def finished(runs: DataFrame) -> DataFrame:
    return runs.where(F.col("status") == "FINISHED")


def with_positive(runs: DataFrame, name: str = BEST_METRIC) -> DataFrame:
    return runs.where(metric(name) > 0)


def best_run(runs: DataFrame, name: str = BEST_METRIC) -> DataFrame:
    """The run with the largest positive metric; ties go to the later start, then the larger id."""
    return (
        with_positive(runs, name)
        .withColumn("best_value", metric(name))
        .orderBy(F.desc("best_value"), F.desc("start_time"), F.desc("run_id"))
        .limit(1)
    )


def latest_run(runs: DataFrame) -> DataFrame:
    return finished(runs).orderBy(F.desc("start_time"), F.desc("run_id")).limit(1)


def recent_runs(runs: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` newest runs of any status with their display fields."""
    newest = runs.orderBy(F.desc("start_time"), F.desc("run_id")).limit(n)
    return newest.select(
        "run_id",
        "status",
        F.coalesce(param("model_type"), F.lit("Unknown")).alias("model_type"),
        *[S.metric_text(metric(name)).alias(label) for label, name in SHOWN.items()],
        F.coalesce(F.date_format("start_time", "yyyy-MM-dd HH:mm:ss"), F.lit("N/A")).alias("start_time"),
    )


def plain_maps(runs: DataFrame) -> DataFrame:
    """Maps without the metrics. / params. / tags. prefixes and without null values."""
    return runs.withColumns(
        {c: S.strip_key_prefix(F.col(c), f"{c}.") for c in ("metrics", "params", "tags")}
    )


def run_row(
    spark: SparkSession, run_id: str, status: str, start, end, metrics: dict[str, float], params: dict[str, str], tags: dict[str, str] | None = None
) -> DataFrame:
    """One ledger row for a run that just ended (or failed)."""
    row = (
        run_id,
        status,
        start,
        end,
        {f"metrics.{k}": float(v) for k, v in metrics.items()},
        {f"params.{k}": str(v) for k, v in params.items()},
        {f"tags.{k}": str(v) for k, v in (tags or {}).items()},
    )
    return spark.createDataFrame([row], RUNS)
