"""Training sets from feature views, and the training job."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.operators import joins as J
from marketloom.operators.cleaning import id_to_string
from marketloom.plans import content, evaluate, feature_state, jobs, runs, svd
from marketloom.schemas import INTERACTION_VIEW, PRODUCT_VIEW, USER_VIEW
from marketloom.session import materialize
from marketloom.sources import snapshots
from marketloom.sources.files import write_csv

VIEWS = "processed/views"  # published feature tables, below the data root

# fixed values: the features a model is trained on (product interaction counts are left out)
USER_COLUMNS = USER_VIEW.features
PRODUCT_COLUMNS = [f for f in PRODUCT_VIEW.features if f != "interaction_count"]
TOP_N = 50
SVD_SAMPLE_USERS = 20
CONTENT_SAMPLE_USERS = 5


def training_set(interactions: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    """Interaction rows with the user and product features valid at their event time."""
    entities = id_to_string(interactions, "user_id", "product_id")
    df = J.snapshot_join(entities, users, USER_VIEW, USER_COLUMNS)
    df = J.snapshot_join(df, products, PRODUCT_VIEW, PRODUCT_COLUMNS)
    score = F.coalesce(F.col("implicit_score").try_cast("double"), F.lit(0.0))
    return df.withColumn("implicit_score", score)


def training_set_of(spark: SparkSession, views: str) -> DataFrame:
    """The published interactions with the user and product features that counted when they happened."""
    newest = snapshots.load_snapshot(spark, views, "interaction_features", feature_state.published_schema("interaction_features"))
    past = {n: snapshots.history(spark, views, n, feature_state.published_schema(n)) for n in ("user_features", "product_features")}
    df = J.history_join(newest, past["user_features"], USER_VIEW, USER_COLUMNS)
    df = J.history_join(df, past["product_features"], PRODUCT_VIEW, PRODUCT_COLUMNS)
    score = F.coalesce(F.col("implicit_score").try_cast("double"), F.lit(0.0))
    return df.withColumn("implicit_score", score)


def train_job(spark: SparkSession, root: str, output: str, ledger: str, as_of: str | None = None, **options) -> DataFrame:
    """Publish the feature state, build the training set from all published versions, fit, evaluate and log.

    The content model takes the newest product features.
    """
    store, views = f"{root}/{jobs.FEATURES}", f"{root}/{VIEWS}"
    feature_state.publish(spark, store, views, as_of or jobs.now())
    training = training_set_of(spark, views)
    products = snapshots.load_snapshot(spark, views, "product_features", feature_state.published_schema("product_features"))
    return train_and_log(training, products, output, ledger, **options)


def feature_service(entities: DataFrame, users: DataFrame, products: DataFrame, interactions: DataFrame) -> DataFrame:
    """All features of the three views for (user, product, event time) rows, each prefixed by its view."""
    df = id_to_string(entities.select("user_id", "product_id", "event_timestamp"), "user_id", "product_id")
    for view, features in ((USER_VIEW, users), (PRODUCT_VIEW, products)):
        df = J.snapshot_join(df, features, view)
        df = df.withColumnsRenamed({n: f"{view.name}__{n}" for n in view.features})
    found = J.asof_join(
        df,
        interactions,
        list(INTERACTION_VIEW.keys),
        INTERACTION_VIEW.features,
        INTERACTION_VIEW.ttl_days * 86_400_000_000,
    )
    names = {n: f"{INTERACTION_VIEW.name}__{n}" for n in INTERACTION_VIEW.features}
    typed = found.withColumns({n: F.col(n).cast(INTERACTION_VIEW.schema[n].dataType) for n in names})
    return typed.withColumnsRenamed(names).drop("feature_timestamp")


def train_and_log(
    training: DataFrame,
    products: DataFrame,
    output: str,
    ledger: str,
    models: tuple[str, ...] = ("svd", "content"),
    n: int = TOP_N,
    method: str = "tiled",
) -> DataFrame:
    """Split, fit, evaluate, write sample recommendations and append the runs to the ledger."""
    spark = training.sparkSession
    flat = materialize(
        training.select("user_id", "product_id", "interaction_date", "implicit_score"), "training"
    )
    train, test = evaluate.split(flat, "user_id", "product_id", "interaction_date")
    for model in models:
        start = datetime.now(timezone.utc)
        if model == "svd":
            fitted = svd.fit(train, method=method)
            recs = materialize(svd.recommend(fitted, n), "recs")
            known = fitted.user_factors.select("user_id")
            logged = {
                "residual": fitted.residual,
                "explained_variance": svd.explained_variance(fitted).first()[0],
                **{f"test_{k}": v for k, v in svd.prediction_error(fitted, test).first().asDict().items()},
            }
            params = {"svd_components": svd.COMPONENTS, "svd_steps": svd.STEPS, "svd_eval_k": n}
            sample, score = evaluate.sample_users(train, SVD_SAMPLE_USERS), "score"
        else:
            vectors = materialize(content.item_vectors(products), "vectors")
            profiles = materialize(content.user_profiles(vectors, train), "profiles")
            recs = materialize(content.recommend(vectors, profiles, train, n), "recs")
            known = content.known_users(profiles)
            sample, score = evaluate.sample_users(train, CONTENT_SAMPLE_USERS), "similarity_score"
            logged = {"avg_confidence": content.average_confidence(recs, sample).first()[0]}
            params = {"eval_k": n}
        ranking = evaluate.ranking_metrics(recs, test, known, n).first()
        logged |= {
            f"precision_{n}": ranking["precision_at_n"],
            f"recall_{n}": ranking["recall_at_n"],
            f"hit_rate_{n}": ranking["hit_rate_at_n"],
        }
        picked = recs.join(sample, "user_id", "left_semi").orderBy("user_id", "rank")
        write_csv(picked.select("user_id", "product_id", F.col("score").alias(score)), f"{output}/{model}_top_n")
        row = runs.run_row(
            spark,
            f"{model}-{start:%Y%m%dT%H%M%S%f}",
            "FINISHED",
            start,
            datetime.now(timezone.utc),
            {f"{model}_{k}": v for k, v in logged.items() if v is not None},
            {"model_type": model, "split_strategy": "hash_70_30", **params},
        )
        runs.append_runs(row, ledger)
    return runs.scan_runs(spark, ledger)
