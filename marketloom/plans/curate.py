"""Curation: raw interactions, profiles and catalog to one wide table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions import scalars as S
from marketloom.operators import cleaning as C
from marketloom.operators import joins as J
from marketloom.operators import scaling as M
from marketloom.operators import windows as W


def curate_interactions(raw: DataFrame) -> DataFrame:
    """De-duplicate, drop null keys, cast ids, encode the event and its time, scale the duration.

    Rows are dropped for null keys before the cast, so an unreadable id stays as id 0.
    """
    keyed = C.drop_null_keys(raw, "user_id", "product_id")
    if "duration_seconds" in raw.columns:
        keyed = C.fill_defaults(keyed, {"duration_seconds": 0})
    # nulls are still apart from zeros while rows are compared
    unique = C.drop_null_keys(raw.dropDuplicates(), "user_id", "product_id")
    if "duration_seconds" in raw.columns:
        unique = C.fill_defaults(unique, {"duration_seconds": 0})
    df = C.tolerant_ids(unique, "user_id", "product_id")
    if "event_type" in df.columns:
        df = df.withColumn("event_strength", S.event_strength(F.col("event_type")))
    if "timestamp" in df.columns:
        df = df.withColumn("dt", S.epoch_to_ts(F.col("timestamp")))
        df = df.withColumns({"hour_of_day": F.hour("dt"), "day_of_week": F.weekday("dt")})
        df = df.withColumns(
            {
                "hour_norm": S.hour_norm(F.col("hour_of_day")),
                "day_norm": S.weekday_norm(F.col("day_of_week")),
            }
        )
    if "duration_seconds" in df.columns:
        df = M.min_max_scale(df, {"duration_seconds": "duration_scaled"}, fit_on=keyed)
    return df


def curate_profiles(raw: DataFrame, wide_one_hot: bool = False) -> DataFrame:
    """Unique profiles with tier flags and median-filled, scaled age.

    Flags are one array of names (``tier_hot``), or with ``wide_one_hot`` a column per tier.
    """
    keyed = C.drop_null_keys(raw, "user_id")
    df = C.tolerant_ids(keyed.dropDuplicates(), "user_id")
    if "tier" in df.columns:
        df = M.one_hot(df, "tier", "tier", M.distinct_values(keyed, "tier")) if wide_one_hot else M.one_hot_sparse(df, "tier", "tier")
    if "age" in df.columns:
        df = M.impute_medians(df, "age")
        df = M.min_max_scale(df, {"age": "age_scaled"}, fit_on=keyed)
    return df


def curate_catalog(raw: DataFrame, wide_one_hot: bool = False) -> DataFrame:
    """Unique products with filled and scaled numbers and one-hot categories.

    The raw text columns stay. Categories are arrays of names (``cat_hot``, ``subcat_hot``),
    so there may be any number of them; ``wide_one_hot`` makes a column per value instead,
    of which there may be a bounded number.
    """
    keyed = C.drop_null_keys(raw, "product_id")
    df = C.tolerant_ids(keyed.dropDuplicates(), "product_id", "category_id", "subcategory_id")
    if wide_one_hot:
        values = M.distinct_values_of(keyed, C.present(df, "category", "subcategory"))
        for column, prefix in (("category", "cat"), ("subcategory", "subcat")):
            if column in values:
                df = M.one_hot(df, column, prefix, values[column])
    else:
        for column, prefix in (("category", "cat"), ("subcategory", "subcat")):
            if column in df.columns:
                df = M.one_hot_sparse(df, column, prefix)
    zeros = {"stock_quantity": 0, "rating_count": 0}
    df = C.fill_defaults(df, zeros)
    outputs = {}
    if "price" in df.columns:
        df = M.impute_medians(df, "price")
        outputs["price"] = "price_scaled"
    if "stock_quantity" in df.columns:
        outputs["stock_quantity"] = "stock_quantity_scaled"
    if outputs:
        df = M.min_max_scale(df, outputs, fit_on=C.fill_defaults(keyed, zeros))
    if "rating_count" in df.columns:
        df = df.withColumn("rating_count_log", F.log1p(F.col("rating_count").cast("double")))
    return df


def merge_curated(
    interactions: DataFrame, profiles: DataFrame | None, catalog: DataFrame | None
) -> DataFrame:
    """Interactions with profile and catalog columns; missing profiles are tolerated, a missing catalog is not.

    All unreadable ids are 0, so either side may hold many rows of that id: profiles and
    catalog give one row per id, or the join would pair them all.
    """
    if catalog is None:
        raise RuntimeError("the catalog is mandatory for curation")
    df = interactions
    if profiles is not None and "user_id" in profiles.columns and "user_id" in df.columns:
        df = J.left_join(df, W.one_per_key(profiles, "user_id"), "user_id", "_profile")
    return J.left_join(df, W.one_per_key(catalog, "product_id"), "product_id", "_catalog")


def curate(interactions: DataFrame, profiles: DataFrame, catalog: DataFrame, wide_one_hot: bool = False) -> DataFrame:
    """The curated dataset. Empty interactions or an empty catalog stop the job."""
    if interactions.isEmpty():
        raise RuntimeError("interactions are missing or empty")
    if catalog.isEmpty():
        raise RuntimeError("the catalog is missing or empty")
    known = None if profiles.isEmpty() else curate_profiles(profiles, wide_one_hot)
    return merge_curated(curate_interactions(interactions), known, curate_catalog(catalog, wide_one_hot))


def lineage_record(
    spark, event_date: str, created_at: Column, sources: dict[str, tuple[str, str]], columns: list[str], row_count: int
) -> DataFrame:
    """One row that says what a curated partition was made from."""
    return spark.range(1).select(
        F.lit(event_date).alias("event_date"),
        created_at.alias("created_at"),
        F.create_map(
            *[
                part
                for name, (day, path) in sources.items()
                for part in (
                    F.lit(name),
                    F.struct(F.lit(day).alias("ingestion_date"), F.lit(path).alias("input_file")),
                )
            ]
        ).alias("sources"),
        F.array(
            *[F.lit(s) for s in ("curate_interactions", "curate_profiles", "curate_catalog", "merge_curated")]
        ).alias("transformations"),
        F.lit(row_count).cast("bigint").alias("row_count"),
        F.array(*[F.lit(c) for c in columns]).alias("columns"),
    )
