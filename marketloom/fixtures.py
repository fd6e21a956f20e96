"""Input tables in the shape of the jobs' raw data, derived from the generated test tables.

Each view exists twice: as a DataFrame here and as DuckDB SQL in
``marketloom.catalog.oracle``; both give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HISTORY_END = 1705276800  # 2024-01-15 UTC: rows before it are history, the rest a new batch


ASIDE = 1_000_000_000  # moves a key out of the range that events use


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def aside(key: str, condition: str) -> Column:
    """The key, moved where the condition holds: joins find rows without a partner on either side."""
    return F.when(F.expr(condition), F.col(key) + ASIDE).otherwise(F.col(key))


def raw_interactions(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    rows = events.select(
        "user_id",
        F.when(
            F.col("event_id") % 97 != 0, F.get_json_object("props", "$.k").cast("bigint")
        ).alias("product_id"),
        F.when(F.col("event_type") == "signup", "add_to_cart")
        .otherwise(F.col("event_type"))
        .alias("event_type"),
        F.unix_timestamp("ts").alias("timestamp"),
        F.when(F.col("event_id") % 17 != 0, F.col("value")).alias("duration_seconds"),
        # every fiftieth event arrives twice
        F.when(F.col("event_id") % 50 == 0, 2).otherwise(1).alias("_copies"),
    )
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).drop("_copies", "_copy")


def raw_profiles(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            aside("c_custkey", "c_custkey % 10 = 9").alias("user_id"),
            F.when(F.col("c_custkey") % 11 != 0, 18 + F.col("c_custkey") % 63).alias("age"),
            F.col("n_name").alias("location_city"),
            F.col("r_name").alias("location_country"),
            F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "premium")
            .otherwise("basic")
            .alias("tier"),
        )
    )


def raw_catalog(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    key, size = F.col("p_partkey"), F.col("p_size").cast("bigint")
    sub = F.split_part("p_name", F.lit(" "), F.lit(2))
    return part.select(
        aside("p_partkey", "p_partkey % 25 = 24").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.length("p_type").cast("bigint").alias("category_id"),
        F.col("p_type").alias("category"),
        F.length(sub).cast("bigint").alias("subcategory_id"),
        sub.alias("subcategory"),
        F.col("p_brand").alias("brand"),
        F.when(key % 13 != 0, F.col("p_retailprice")).alias("price"),
        (1.0 + (size % 9) / 2.0).alias("rating_avg"),
        F.when(key % 7 != 0, size * 3).alias("rating_count"),
        F.when(key % 19 != 0, size).alias("stock_quantity"),
    )


def raw_order_interactions(spark: SparkSession, sf: str) -> DataFrame:
    lineitem, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("product_id"),
        F.when(F.col("l_returnflag") == "R", "view")
        .when(F.col("l_returnflag") == "A", "click")
        .when(F.col("l_linestatus") == "F", "add_to_cart")
        .otherwise("purchase")
        .alias("event_type"),
        F.unix_timestamp("l_shipdate").alias("timestamp"),
        F.col("l_quantity").alias("duration_seconds"),
    )


def raw_runs(spark: SparkSession, sf: str) -> DataFrame:
    """A run ledger with one run per order; metrics and parameters carry their ledger prefixes."""
    orders, key = table(spark, sf, "orders"), F.col("o_orderkey")
    start = F.timestamp_micros((F.unix_timestamp("o_orderdate") + key % 86400) * 1000000)
    content = key % 2 == 0
    score = (key * 7919 % 1000) / 1000.0
    return orders.select(
        F.concat(F.lit("run-"), key.cast("string")).alias("run_id"),
        F.when(F.col("o_orderstatus") == "F", "FINISHED")
        .when(F.col("o_orderstatus") == "O", "RUNNING")
        .otherwise("FAILED")
        .alias("status"),
        start.alias("start_time"),
        F.when(
            F.col("o_orderstatus") != "O",
            F.timestamp_micros(F.unix_micros(start) + (key % 5000) * 1000000),
        ).alias("end_time"),
        F.create_map(
            F.lit("metrics.content_hit_rate_50"),
            F.when(content & (key % 5 != 0), score),
            F.lit("metrics.content_precision_50"),
            F.when(content, score / 10.0),
            F.lit("metrics.svd_hit_rate_50"),
            F.when(~content & (key % 5 != 0), score),
            F.lit("metrics.svd_precision_50"),
            F.when(~content, score / 10.0),
        ).alias("metrics"),
        F.create_map(
            F.lit("params.model_type"),
            F.when(key % 10 != 0, F.when(content, "content").otherwise("svd")),
            F.lit("params.eval_k"),
            F.lit("50"),
        ).alias("params"),
        F.create_map(F.lit("tags.clerk"), F.col("o_orderpriority")).alias("tags"),
    )
