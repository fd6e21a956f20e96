"""Exploratory tables: the integrated dataset, popularity and correlations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions import scalars as S
from marketloom.operators import aggregates as A
from marketloom.operators import cleaning as C
from marketloom.operators import joins as J
from marketloom.operators import scaling as M

# fixed values
IMPUTED = ["age_scaled", "price_scaled", "rating_avg", "rating_count", "rating_count_log", "stock_quantity_scaled"]
CORRELATED = ["duration_seconds", "age", "price", "rating_avg"]


def eda_interactions(raw: DataFrame) -> DataFrame:
    keyed = C.fill_defaults(C.drop_null_keys(raw, "user_id", "product_id"), {"duration_seconds": 0})
    unique = C.fill_defaults(
        C.drop_null_keys(raw.dropDuplicates(), "user_id", "product_id"), {"duration_seconds": 0}
    )
    df = C.tolerant_ids(unique, "user_id", "product_id")
    df = df.withColumn("event_strength", S.event_strength(F.col("event_type")))
    df = M.min_max_scale(df, {"duration_seconds": "duration_scaled"}, fit_on=keyed)
    df = df.withColumn("dt", S.epoch_to_ts(F.col("timestamp")))
    df = df.withColumns({"hour_of_day": F.hour("dt"), "day_of_week": F.weekday("dt")})
    return df.withColumns(
        {"hour_norm": S.hour_norm(F.col("hour_of_day")), "day_norm": S.weekday_norm(F.col("day_of_week"))}
    )


def eda_profiles(raw: DataFrame, wide_one_hot: bool = False) -> DataFrame:
    """Tier becomes flags and is dropped; age is scaled with its nulls kept."""
    keyed = C.drop_null_keys(raw, "user_id")
    df = C.tolerant_ids(keyed.dropDuplicates(), "user_id")
    flagged = M.one_hot(df, "tier", "tier", M.distinct_values(keyed, "tier")) if wide_one_hot else M.one_hot_sparse(df, "tier", "tier")
    df = flagged.drop("tier")
    return M.min_max_scale(df, {"age": "age_scaled"}, fit_on=keyed)


def eda_catalog(raw: DataFrame, wide_one_hot: bool = False) -> DataFrame:
    """Scaled catalog; only stock is zero-filled, and only for scaling."""
    keyed = C.drop_null_keys(raw, "product_id")
    df = C.tolerant_ids(keyed.dropDuplicates(), "product_id")
    if wide_one_hot:
        values = M.distinct_values_of(keyed, ["category", "subcategory"])
        for column, prefix in (("category", "cat"), ("subcategory", "subcat")):
            df = M.one_hot(df, column, prefix, values[column])
    else:
        for column, prefix in (("category", "cat"), ("subcategory", "subcat")):
            df = M.one_hot_sparse(df, column, prefix)
    stock = F.coalesce(F.col("stock_quantity"), F.lit(0))
    df = M.min_max_scale(
        df.withColumn("_stock", stock),
        {"price": "price_scaled", "_stock": "stock_quantity_scaled"},
        fit_on=keyed.withColumn("_stock", stock),
    ).drop("_stock")
    return df.withColumn("rating_count_log", F.log1p(F.col("rating_count").cast("double")))


def integrate(interactions: DataFrame, profiles: DataFrame, catalog: DataFrame) -> DataFrame:
    """Both left joins, median fill of the scaled columns, 0 for every other numeric null."""
    df = J.left_join(J.left_join(interactions, profiles, "user_id", "_y"), catalog, "product_id", "_y")
    df = M.impute_medians(df, *C.present(df, *IMPUTED))
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in numeric})


def eda_dataset(interactions: DataFrame, profiles: DataFrame, catalog: DataFrame, wide_one_hot: bool = False) -> DataFrame:
    return integrate(eda_interactions(interactions), eda_profiles(profiles, wide_one_hot), eda_catalog(catalog, wide_one_hot))


def top_products(interactions: DataFrame, catalog: DataFrame, k: int = 10) -> DataFrame:
    """Most frequent product names; interactions are counted per product before the catalog join."""
    counts = A.count_by_key(interactions, "product_id")
    named = counts.join(catalog.select("product_id", "product_name"), "product_id")
    return (
        named.where(F.col("product_name").isNotNull())
        .groupBy("product_name")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "product_name")
        .limit(k)
    )
