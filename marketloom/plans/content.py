"""Content-based recommender: item vectors, user profiles, cosine top-N."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.operators import scaling as M
from marketloom.operators import scoring

# fixed values: the attributes an item vector is made of
NUMERIC = [
    "price_scaled",
    "rating_avg",
    "popularity_score",
    "diversity_score",
    "rating_count_log",
    "stock_quantity_scaled",
]
CATEGORICAL = ["category", "brand", "subcategory"]


def item_vectors(products: DataFrame) -> DataFrame:
    """Item vectors in long form: (product_id, dim, value), one row per non-structural entry.

    Numbers are read leniently (unreadable or null is 0) and min-max scaled; each
    distinct text, null included, is its own 0/1 dimension. The long form has no
    limit on the number of distinct texts.
    """
    numbers = products.select(
        "product_id", *[F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)).alias(c) for c in NUMERIC]
    )
    scaled = M.min_max_scale(numbers, {c: c for c in NUMERIC})
    cells = [F.struct(F.lit(c).alias("dim"), F.col(c).alias("value")) for c in NUMERIC]
    numeric = scaled.select("product_id", F.inline(F.array(*cells)))
    return numeric.unionByName(M.one_hot_long(products, "product_id", *CATEGORICAL))


def user_profiles(vectors: DataFrame, interactions: DataFrame) -> DataFrame:
    """Weighted mean of the item vectors a user interacted with: (user_id, dim, value).

    Repeats of a pair are added up before the join, so it sees each pair once.
    Items outside the catalog do not count, nor do users without any weight.
    """
    weights = interactions.groupBy("user_id", "product_id").agg(
        F.coalesce(F.sum("implicit_score"), F.lit(0.0)).cast("double").alias("w")
    )
    catalog = vectors.select("product_id").distinct()
    weighted = weights.join(catalog, "product_id", "left_semi")
    totals = weighted.groupBy("user_id").agg(F.sum("w").alias("total")).where("total > 0")
    sums = (
        weighted.join(vectors, "product_id")
        .groupBy("user_id", "dim")
        .agg(F.sum(F.col("w") * F.col("value")).alias("s"))
    )
    return sums.join(totals, "user_id").select("user_id", "dim", (F.col("s") / F.col("total")).alias("value"))


def seen_pairs(interactions: DataFrame) -> DataFrame:
    return interactions.select("user_id", "product_id").distinct()


def known_users(profiles: DataFrame) -> DataFrame:
    return profiles.select("user_id").distinct()


def recommend(vectors: DataFrame, profiles: DataFrame, interactions: DataFrame, n: int = 10, **options) -> DataFrame:
    """Best ``n`` unseen items per profiled user by cosine similarity."""
    users = scoring.pack_vectors(profiles, "user_id")
    items = scoring.pack_vectors(vectors, "product_id")
    return scoring.recommend(users, items, seen_pairs(interactions), n, cosine=True, **options)


def average_confidence(recs: DataFrame, users: DataFrame) -> DataFrame:
    """Mean over the sample users of the mean score of their recommendations; 0 without any."""
    per_user = recs.join(users, "user_id", "left_semi").groupBy("user_id").agg(F.avg("score").alias("s"))
    return per_user.agg(F.coalesce(F.avg("s"), F.lit(0.0)).alias("avg_confidence"))
