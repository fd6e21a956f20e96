"""Feature tables at user, product and (user, product, date) grain.

Each table has a full build and an incremental update. ``*_aggregates`` leave
unknown values null; ``finish_*`` fill and align them, which the updates do only
after merging, so a day without a value never hides an older known one.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions import scalars as S
from marketloom.operators import aggregates as A
from marketloom.operators import cleaning as C
from marketloom.operators import windows as W
from marketloom.session import materialize
from marketloom.schemas import (
    FEATURE_EPOCH,
    INTERACTION_FEATURES,
    PRODUCT_FEATURES,
    USER_FEATURES,
)

# fixed values: columns carried from profiles and catalog
USER_ATTRIBUTES = ["age", "age_scaled", "location_city", "location_country", "tier"]
PRODUCT_ATTRIBUTES = [
    "category_id",
    "category",
    "subcategory_id",
    "subcategory",
    "brand",
    "price",
    "price_scaled",
    "rating_avg",
    "rating_count",
    "rating_count_log",
    "stock_quantity_scaled",
]


def stamp(as_of: str | datetime | Column) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def _hot_columns(df: DataFrame, prefix: str) -> list[str]:
    return [f.name for f in df.schema if f.name.startswith(prefix) and isinstance(f.dataType, T.NumericType)]


# --- users ----------------------------------------------------------------


def user_aggregates(df: DataFrame) -> DataFrame:
    """Counts, lifespan, purchases, category preference and attributes per user.

    Attributes and category are grouping keys of the first step, which is a plain
    hash aggregate with map-side combine; the second step sees a few rows per user.
    """
    C.require(df, "user_id", "timestamp")
    attributes = C.present(df, *USER_ATTRIBUTES)
    category = C.present(df, "category")
    hot_cats = [] if category else _hot_columns(df, "cat_")
    hot_tiers = [] if "tier" in df.columns else _hot_columns(df, "tier_")
    slim = (
        C.drop_null_keys(df, "user_id")
        .groupBy("user_id", *category, *attributes)
        .agg(
            A.rows().alias("n"),
            F.count_if(S.purchase_mask(df)).alias("purchases"),
            F.min("timestamp").alias("first_at"),
            F.max("timestamp").alias("last_at"),
            *[F.sum(F.col(f"`{c}`")).alias(c) for c in hot_cats],
            *[F.max(F.col(f"`{c}`")).alias(c) for c in hot_tiers],
        )
    )
    # (user, category) rows, so that the mode counts every row of a category once
    by_category = slim.groupBy("user_id", *category).agg(
        *[F.sum(c).alias(c) for c in ("n", "purchases", *hot_cats)],
        *[F.max(c).alias(c) for c in hot_tiers],
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
        *[A.first_known(c, "first_at").alias(c) for c in attributes],
        *[
            F.min(F.when(F.col(c).isNotNull(), F.col("first_at"))).alias(f"_at_{c}")
            for c in attributes
        ],
    )
    users = by_category.groupBy("user_id").agg(
        F.sum("n").alias("interaction_count"),
        F.sum("purchases").alias("purchases"),
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
        *[A.first_known(c, f"_at_{c}").alias(c) for c in attributes],
        *[A.top_value("category").alias("preferred_category") for _ in category],
        *[A.top_fraction("category").alias("category_confidence") for _ in category],
        *[F.sum(c).alias(c) for c in hot_cats],
        *[F.max(c).alias(c) for c in hot_tiers],
    )
    if hot_cats:
        users = users.withColumns(
            {
                "preferred_category": A.argmax_columns(hot_cats, "cat_"),
                "category_confidence": S.ratio(F.greatest(*hot_cats) if len(hot_cats) > 1 else F.col(hot_cats[0]), F.col("interaction_count")),
            }
        )
    if hot_tiers:
        users = users.withColumn("tier", A.argmax_columns(hot_tiers, "tier_"))
    return users.withColumns(
        {
            "first_interaction": S.epoch_to_ts(F.col("first_at")),
            "last_interaction": S.epoch_to_ts(F.col("last_at")),
        }
    ).drop("first_at", "last_at", *hot_cats, *hot_tiers)


def finish_users(df: DataFrame) -> DataFrame:
    """Derived ratios and the fixed column list."""
    derived = df.withColumns(
        {
            "purchase_ratio": S.ratio(F.col("purchases"), F.col("interaction_count")),
            "activity_frequency": F.col("interaction_count")
            / S.days_between(F.col("first_interaction"), F.col("last_interaction")),
        }
    )
    return C.align_schema(derived, USER_FEATURES)


def user_features(df: DataFrame, as_of=FEATURE_EPOCH) -> DataFrame:
    return finish_users(C.with_audit(user_aggregates(df), stamp(as_of)))


# fixed values: how a column of two batches is merged
USER_RULES = {
    "interaction_count": "sum",
    "purchases": "sum",
    "first_interaction": "min",
    "last_interaction": "max",
    **{c: "last" for c in USER_ATTRIBUTES},
    "preferred_category": "last",
    "category_confidence": "last",
    "created_at": "first",
}


def _in_order(previous: DataFrame, batch: DataFrame) -> DataFrame:
    return C.union_by_name(previous.withColumn("_seq", F.lit(0)), batch.withColumn("_seq", F.lit(1)))


def update_users(previous: DataFrame, batch: DataFrame, as_of=FEATURE_EPOCH) -> DataFrame:
    """Merge a batch into a user snapshot: counts add, ranges widen, attributes take the newest known.

    Purchases are whole numbers, so rounding ratio x count restores them exactly.
    """
    restored = previous.withColumn(
        "purchases", F.round(F.col("purchase_ratio") * F.col("interaction_count")).cast("bigint")
    )
    fresh = C.with_audit(user_aggregates(batch), stamp(as_of))
    merged = A.rule_aggregate(_in_order(restored, fresh), "user_id", USER_RULES, "_seq")
    return finish_users(merged.withColumn("updated_at", stamp(as_of)))


# --- products -------------------------------------------------------------


def product_aggregates(df: DataFrame) -> DataFrame:
    """Counts, distinct users, purchases and catalog attributes per product.

    Two hash aggregates over pruned columns, both ending partitioned by product,
    so their join adds no shuffle.
    """
    C.require(df, "product_id", "user_id")
    keyed = C.drop_null_keys(df, "product_id")
    measured = (
        keyed.groupBy("product_id", "user_id")
        .agg(A.rows().alias("n"), F.count_if(S.purchase_mask(df)).alias("purchases"))
        .groupBy("product_id")
        .agg(
            F.sum("n").alias("interaction_count"),
            F.count("user_id").alias("unique_users"),
            F.sum("purchases").alias("purchases"),
        )
    )
    attributes = C.present(df, *PRODUCT_ATTRIBUTES)
    if attributes:
        order = "timestamp" if "timestamp" in df.columns else "product_id"
        described = A.first_non_null(keyed, "product_id", attributes, order)
        measured = measured.join(described, "product_id")
    for column, prefix in (("category", "cat_"), ("subcategory", "subcat_")):
        hot = [] if column in df.columns else _hot_columns(df, prefix)
        if hot:
            named = A.argmax_one_hot(keyed, "product_id", hot, prefix, how="max")
            measured = measured.join(named.withColumnRenamed("top_name", column), "product_id")
    return measured


def finish_products(df: DataFrame, counts: DataFrame) -> DataFrame:
    """Derived scores and the fixed column list; popularity is relative to the largest of ``counts``."""
    derived = W.share_of_max(df, "interaction_count", "popularity_score", counts).withColumns(
        {
            "conversion_rate": S.ratio(F.col("purchases"), F.col("interaction_count")),
            "diversity_score": S.ratio(F.col("unique_users"), F.col("interaction_count")),
        }
    )
    return C.align_schema(derived, PRODUCT_FEATURES)


def product_features(df: DataFrame, as_of=FEATURE_EPOCH) -> DataFrame:
    # one row per product, written once: the largest count is read from it and not from the interactions again
    products = materialize(product_aggregates(df), "products")
    return finish_products(C.with_audit(products, stamp(as_of)), products)


# fixed values: how a column of two batches is merged
PRODUCT_RULES = {
    "interaction_count": "sum",
    "unique_users": "sum",
    "purchases": "sum",
    **{c: "last" for c in PRODUCT_ATTRIBUTES},
    "created_at": "first",
}


def update_products(previous: DataFrame, batch: DataFrame, as_of=FEATURE_EPOCH) -> DataFrame:
    """Merge a batch into a product snapshot. ``unique_users`` adds up: an upper bound over batches."""
    restored = previous.withColumn(
        "purchases", F.round(F.col("conversion_rate") * F.col("interaction_count")).cast("bigint")
    )
    fresh = C.with_audit(product_aggregates(batch), stamp(as_of))
    merged = materialize(A.rule_aggregate(_in_order(restored, fresh), "product_id", PRODUCT_RULES, "_seq"), "products")
    return finish_products(merged.withColumn("updated_at", stamp(as_of)), merged)


# --- interactions ---------------------------------------------------------


def interaction_features(df: DataFrame, as_of=FEATURE_EPOCH) -> DataFrame:
    """Counts, implicit score, cyclic time and lag per (user, product, date)."""
    C.require(df, "user_id", "product_id", "timestamp")
    keys = ["user_id", "product_id", "interaction_date"]
    dated = df.withColumn("interaction_date", F.to_date(S.epoch_to_ts(F.col("timestamp"))))
    score = sum_score = A.rows()
    if "event_strength" in df.columns:
        sum_score = A.sum_or_zero(F.col("event_strength"))
    duration = F.avg("duration_scaled") if "duration_scaled" in df.columns else F.lit(0.0)
    daily = (
        C.drop_null_keys(dated, *keys)
        .groupBy(*keys)
        .agg(
            score.alias("interaction_count"),
            sum_score.alias("implicit_score"),
            F.sum("timestamp").alias("_seconds"),
            duration.alias("duration_scaled"),
        )
        .withColumn(
            "_us", S.mean_timestamp_micros(F.col("_seconds"), F.col("interaction_count"))
        )
    )
    moment = F.timestamp_micros("_us")
    hour_sin, hour_cos = S.cyclic(F.hour(moment), 24)
    day_sin, day_cos = S.cyclic(F.weekday(moment), 7)
    full = daily.withColumns(
        {
            "hour_sin": hour_sin,
            "hour_cos": hour_cos,
            "day_sin": day_sin,
            "day_cos": day_cos,
            "time_since_last_seconds": W.lag_seconds(daily, ["user_id", "product_id"], "_us"),
            "created_at": stamp(as_of),
        }
    ).drop("_seconds", "_us")
    return C.align_schema(full, INTERACTION_FEATURES)


def update_interactions(previous: DataFrame, batch: DataFrame, as_of=FEATURE_EPOCH) -> DataFrame:
    """Append a batch; a later row of the same (user, product, date) replaces the earlier one."""
    fresh = interaction_features(batch, as_of)
    return W.keep_last([previous, fresh], ["user_id", "product_id", "interaction_date"], unique=True)


# --- snapshots for feature views -----------------------------------------


def with_event_time(df: DataFrame, as_of=FEATURE_EPOCH) -> DataFrame:
    """Stamp a snapshot with its event time and make its ids text, as the feature views expect."""
    return C.id_to_string(df.withColumn("event_timestamp", stamp(as_of)), "user_id", "product_id")
