"""Hold-out split, ranking metrics and the sample of users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions.scalars import hold_out_bucket

TEST_PERCENT = 30  # fixed value


def split(df: DataFrame, *keys: str, test_percent: int = TEST_PERCENT) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the row's keys: repeatable, and needs no shuffle."""
    bucket = hold_out_bucket(*[F.col(k) for k in keys])
    return df.where(bucket >= test_percent), df.where(bucket < test_percent)


def hits_per_user(recs: DataFrame, test: DataFrame, known: DataFrame) -> DataFrame:
    """(user_id, actual, hits) for every test user the model knows."""
    actual = test.select("user_id", "product_id").distinct().join(known, "user_id", "left_semi")
    marked = recs.select("user_id", "product_id").withColumn("_hit", F.lit(1))
    return (
        actual.join(marked, ["user_id", "product_id"], "left")
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("actual"), F.count("_hit").alias("hits"))
    )


def ranking_metrics(recs: DataFrame, test: DataFrame, known: DataFrame, n: int) -> DataFrame:
    """Precision@n, recall@n and hit rate@n averaged over known test users.

    Precision divides by ``n`` even if fewer items were recommended; test pairs
    that were seen in training stay in the denominator of recall.
    """
    users = hits_per_user(recs, test, known)
    zero = F.lit(0.0)
    return users.agg(
        F.count(F.lit(1)).alias("evaluated_users"),
        F.coalesce(F.avg(F.col("hits") / F.lit(float(n))), zero).alias("precision_at_n"),
        F.coalesce(F.avg(F.col("hits") / F.col("actual")), zero).alias("recall_at_n"),
        F.coalesce(F.avg((F.col("hits") > 0).cast("double")), zero).alias("hit_rate_at_n"),
    )


def sample_users(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` distinct users in id order."""
    return df.select("user_id").distinct().orderBy("user_id").limit(n)
