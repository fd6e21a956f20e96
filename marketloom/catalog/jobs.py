"""Composite jobs: curation, features, feature views, exploration, and streaming."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom import fixtures as X
from marketloom.catalog import oracle as O
from marketloom.catalog.base import register
from marketloom.catalog.oracle import r6, when, with_
from marketloom.catalog.scans_sinks import (
    DAY,
    dated,
    pandas_like,
    CATALOG_ROWS,
    CURATED_ROWS,
    INTERACTION_ROWS,
    NEW_PRODUCTS,
    PRODUCT_ROWS,
    RAW_ROWS,
    USER_ROWS,
)
from marketloom.catalog.relational import KEEP_LAST
from marketloom.catalog.stages import TRAINED_AT, history, new_batch, stage
from marketloom.operators import aggregates as A
from marketloom.operators import joins as J
from marketloom.plans import curate, eda, feature_state, features, jobs, training
from marketloom.schemas import (
    CATALOG,
    INTERACTION_FEATURES,
    INTERACTION_VIEW,
    INTERACTIONS,
    PRODUCT_VIEW,
    USER_VIEW,
)
from marketloom.session import scratch_path
from marketloom.sources import files, listing, snapshots
from marketloom.streaming import jobs as streams

_CI = ["duration_seconds", "hour_norm", "day_norm", "duration_scaled"]


@register(
    "curate_interactions",
    with_(
        f"SELECT user_id, product_id, event_type, timestamp, event_strength, hour_of_day, day_of_week, {', '.join(r6(c, c) for c in _CI)}, {when('dt', 'dt')} FROM cur_interactions",
        "cur_interactions",
    ),
)
def curate_interactions(spark, sf):
    return curate.curate_interactions(X.raw_interactions(spark, sf))


@register(
    "curate_profiles",
    with_(
        f"SELECT user_id, location_city, location_country, tier, tier_basic, tier_premium, {r6('age', 'age')}, {r6('age_scaled', 'age_scaled')} FROM cur_profiles",
        "cur_profiles",
    ),
)
def curate_profiles(spark, sf):
    return curate.curate_profiles(X.raw_profiles(spark, sf), wide_one_hot=True)


_CC = ["price", "rating_avg", "price_scaled", "stock_quantity_scaled", "rating_count_log"]
_HOT = [f"cat_{c}" for c in O.CATEGORIES] + [f"subcat_{c}" for c in O.SUBCATEGORIES]


@register(
    "curate_catalog",
    with_(
        f"""SELECT product_id, product_name, category_id, category, subcategory_id, subcategory, brand, rating_count, stock_quantity, {', '.join(_HOT)},
 {', '.join(r6(c, c) for c in _CC)} FROM cur_catalog""",
        "cur_catalog",
    ),
)
def curate_catalog(spark, sf):
    return curate.curate_catalog(X.raw_catalog(spark, sf), wide_one_hot=True)


@register("curated_dataset", with_(CURATED_ROWS, "curated"))
def curated_dataset(spark, sf):
    return curate.curate(X.raw_interactions(spark, sf), X.raw_profiles(spark, sf), X.raw_catalog(spark, sf), wide_one_hot=True)


# --- features -------------------------------------------------------------


@register("user_features", with_(f"{USER_ROWS} FROM user_features", "user_features"))
def user_features(spark, sf):
    return features.user_features(stage(spark, sf, "curated"))


NEW_USERS = O.finish_users(
    "SELECT * REPLACE (least(first_o, first_n) AS first_at, greatest(last_o, last_n) AS last_at) FROM ("
    + O.merged(
        O.users_of("curated_old"), O.users_of("curated_new"), "user_id", ["interaction_count", "purchases"],
        [*O.USER_ATTRIBUTES, "preferred_category", "category_confidence", "first_at", "last_at"],
        ", o.first_at AS first_o, n.first_at AS first_n, o.last_at AS last_o, n.last_at AS last_n",
    )
    + ")"
)


@register("user_features_update", with_(f"{USER_ROWS} FROM ({NEW_USERS})", "curated_old", "curated_new"))
def user_features_update(spark, sf):
    return features.update_users(stage(spark, sf, "user_features_old"), new_batch(stage(spark, sf, "curated")))


@register("product_features", with_(f"{PRODUCT_ROWS} FROM product_features", "product_features"))
def product_features(spark, sf):
    return features.product_features(stage(spark, sf, "curated"))


@register("product_features_update", with_(f"{PRODUCT_ROWS} FROM ({NEW_PRODUCTS})", "curated_old", "curated_new"))
def product_features_update(spark, sf):
    return features.update_products(stage(spark, sf, "product_features_old"), new_batch(stage(spark, sf, "curated")))


@register("interaction_features", with_(f"{INTERACTION_ROWS} FROM interaction_features", "interaction_features"))
def interaction_features(spark, sf):
    return features.interaction_features(stage(spark, sf, "curated"))


@register("interaction_features_update", with_(f"{INTERACTION_ROWS} FROM ({KEEP_LAST})", "curated_old", "curated_new"))
def interaction_features_update(spark, sf):
    return features.update_interactions(stage(spark, sf, "interaction_features_old"), new_batch(stage(spark, sf, "curated")))


def table_sizes(spark, store, *extra):
    """(table, rows, interactions) of the current snapshot."""
    parts = None
    for name in feature_state.SCHEMAS:
        row = feature_state.load(spark, store, name).agg(A.rows().alias("n"), F.sum("interaction_count").alias("interactions")).select(
            F.lit(name).alias("name"), "n", "interactions", *extra
        )
        parts = row if parts is None else parts.unionByName(row)
    return parts


@register(
    "feature_job",
    with_(
        """SELECT 'user_features' AS name, count(DISTINCT user_id) AS n, count(*) AS interactions, 1::BIGINT AS applied_first, 0::BIGINT AS applied_again FROM curated
 UNION ALL SELECT 'product_features', count(DISTINCT product_id), count(*), 1, 0 FROM curated
 UNION ALL SELECT 'interaction_features', count(*), sum(interaction_count)::BIGINT, 1, 0 FROM interaction_features""",
        "curated", "interaction_features",
    ),
)
def feature_job(spark, sf):
    """A full build of the newer date, an update by the older one in a wrong and then in its right form, and a repeat."""
    root = scratch_path(spark, "lake")
    cur = stage(spark, sf, "curated")
    curated = f"{root}/{jobs.CURATED}"
    files.write_date(new_batch(cur), curated, "20240131", "event_date")
    jobs.feature_job(spark, root)
    files.write_date(history(cur).where("user_id % 2 = 0"), curated, "20240114", "event_date")
    jobs.feature_job(spark, root, incremental=True, date="20240114")
    files.write_date(history(cur), curated, "20240114", "event_date")
    first = jobs.feature_job(spark, root, incremental=True, date="20240114")
    again = jobs.feature_job(spark, root, incremental=True)
    flags = (F.lit(int(first)).alias("applied_first"), F.lit(int(again)).alias("applied_again"))
    return table_sizes(spark, f"{root}/{jobs.FEATURES}", *flags)


# --- feature views --------------------------------------------------------


def f32(column: str, name: str | None = None) -> str:
    return r6(f"{column}::FLOAT", name or column)


@register(
    "feature_view_project",
    with_(
        f"""SELECT user_id::VARCHAR AS user_id, '2025-01-01 00:00:00' AS event_timestamp, trunc(age)::BIGINT AS age, {f32('age_scaled')}, location_city, location_country, tier,
 interaction_count, {f32('activity_frequency')}, {f32('purchase_ratio')}, preferred_category, {f32('category_confidence')} FROM user_features""",
        "user_features",
    ),
)
def feature_view_project(spark, sf):
    return J.project_view(features.with_event_time(stage(spark, sf, "user_features")), USER_VIEW)


def view_sql(view, alias: str, prefix: str = "", skip: tuple[str, ...] = (), rename: dict[str, str] | None = None) -> str:
    columns = []
    for field in view.schema:
        if field.name in skip:
            continue
        name = (rename or {}).get(field.name, f"{prefix}{field.name}")
        source = f"{alias}.{field.name}"
        kind = field.dataType.simpleString()
        # a fraction (an imputed age) becomes an integer by truncation, as in every other integer cast
        plain = f"trunc({source})::BIGINT" if kind == "bigint" else source
        columns.append(f32(source, name) if kind == "float" else f"{plain} AS {name}")
    return ", ".join(columns)


_ENTITY = ["interaction_count", "time_since_last_seconds"]
_ENTITY_R6 = ["implicit_score", "hour_sin", "hour_cos", "day_sin", "day_cos", "duration_scaled"]


@register(
    "training_set",
    with_(
        f"""SELECT i.user_id::VARCHAR AS user_id, i.product_id::VARCHAR AS product_id, {', '.join(f'i.{c} AS {c}' for c in _ENTITY)},
 {', '.join(r6(f'i.{c}', c) for c in _ENTITY_R6)}, strftime(i.interaction_date, '%Y-%m-%d') AS interaction_date, '2025-01-01 00:00:00' AS created_at,
 '{TRAINED_AT}' AS event_timestamp, {view_sql(USER_VIEW, 'u', rename={'interaction_count': 'user_features__interaction_count'})},
 {view_sql(PRODUCT_VIEW, 'p', skip=('interaction_count',))}
 FROM interaction_features i LEFT JOIN user_features u ON i.user_id = u.user_id LEFT JOIN product_features p ON i.product_id = p.product_id""",
        "interaction_features", "user_features", "product_features",
    ),
)
def training_set(spark, sf):
    return training.training_set(
        features.with_event_time(stage(spark, sf, "interaction_features"), TRAINED_AT),
        features.with_event_time(stage(spark, sf, "user_features")),
        features.with_event_time(stage(spark, sf, "product_features")),
    )


@register(
    "feature_service",
    with_(
        f"""SELECT e.user_id::VARCHAR AS user_id, e.product_id::VARCHAR AS product_id, strftime(e.d, '%Y-%m-%d %H:%M:%S') AS event_timestamp,
 {view_sql(USER_VIEW, 'u', 'user_features__')}, {view_sql(PRODUCT_VIEW, 'p', 'product_features__')}, {view_sql(INTERACTION_VIEW, 'i', 'interaction_features__')}
 FROM (SELECT user_id, product_id, interaction_date::TIMESTAMP + INTERVAL 36 HOUR + INTERVAL 1 YEAR AS d, interaction_date AS at FROM interaction_features) e
 LEFT JOIN user_features u ON e.user_id = u.user_id LEFT JOIN product_features p ON e.product_id = p.product_id
 ASOF LEFT JOIN (SELECT *, interaction_date::TIMESTAMP + INTERVAL 1 YEAR AS ts FROM interaction_features) i
  ON e.user_id = i.user_id AND e.product_id = i.product_id AND e.d >= i.ts""",
        "interaction_features", "user_features", "product_features",
    ),
)
def feature_service(spark, sf):
    """Entities ask 36 hours after each interaction; interaction features carry their own dates, a year later than the data."""
    rows = stage(spark, sf, "interaction_features")
    shifted = rows.withColumn("_day", F.col("interaction_date").cast("timestamp") + F.expr("INTERVAL 1 YEAR"))
    entities = shifted.withColumn("event_timestamp", F.col("_day") + F.expr("INTERVAL 36 HOURS"))
    return training.feature_service(
        entities,
        features.with_event_time(stage(spark, sf, "user_features")),
        features.with_event_time(stage(spark, sf, "product_features")),
        features.with_event_time(shifted, F.col("_day")),
    )


_EDA = ["age_scaled", "price_scaled", "rating_avg", "rating_count", "rating_count_log", "stock_quantity_scaled"]
_STOCK = "coalesce(stock_quantity, 0)"


@register(
    "eda_dataset",
    with_(
        f"""SELECT user_id, product_id, event_type, timestamp, event_strength, {r6('duration_scaled', 'duration_scaled')}, coalesce(age, 0) AS age,
 coalesce((tier = 'basic')::BIGINT, 0) AS tier_basic, coalesce((tier = 'premium')::BIGINT, 0) AS tier_premium,
 {', '.join(f"coalesce(cat_{c}, 0) AS cat_{c}" for c in O.CATEGORIES)}, location_city, product_name, {r6('coalesce(price, 0)', 'price')},
 coalesce(stock_quantity, 0) AS stock_quantity, {', '.join(r6(f'coalesce({c}, median({c}) OVER ())', c) for c in _EDA)}
 FROM cur_interactions LEFT JOIN (SELECT *, {O.mm('age', 'min(age) OVER ()', 'max(age) OVER ()')} AS age_scaled FROM raw_profiles) USING (user_id)
 LEFT JOIN (SELECT *, {O.HOT}, {O.mm('price', 'min(price) OVER ()', 'max(price) OVER ()')} AS price_scaled, ln(1 + rating_count) AS rating_count_log,
  {O.mm(_STOCK, f'min({_STOCK}) OVER ()', f'max({_STOCK}) OVER ()')} AS stock_quantity_scaled FROM raw_catalog) USING (product_id)""",
        "cur_interactions", "raw_profiles", "raw_catalog",
    ),
)
def eda_dataset(spark, sf):
    df = eda.eda_dataset(X.raw_interactions(spark, sf), X.raw_profiles(spark, sf), X.raw_catalog(spark, sf), wide_one_hot=True)
    return df.select(
        "user_id", "product_id", "event_type", "timestamp", "event_strength", "duration_scaled", "age", "tier_basic", "tier_premium",
        *[f"cat_{c}" for c in O.CATEGORIES], "location_city", "product_name", "price", "stock_quantity", *_EDA,
    )


@register(
    "transformer_chain",
    with_(f"SELECT user_id, product_id, {r6('coalesce(duration_seconds, 0)', 'duration_seconds')}, {O.STRENGTH} AS event_strength FROM raw_interactions WHERE product_id IS NOT NULL", "raw_interactions"),
)
def transformer_chain(spark, sf):
    """User-defined steps are plain functions chained with ``DataFrame.transform``."""
    from marketloom.functions.scalars import event_strength
    from marketloom.operators.cleaning import drop_null_keys, fill_defaults

    return (
        X.raw_interactions(spark, sf)
        .transform(drop_null_keys, "product_id")
        .transform(fill_defaults, {"duration_seconds": 0})
        .withColumn("event_strength", event_strength(F.col("event_type")))
        .select("user_id", "product_id", "duration_seconds", "event_strength")
    )


# --- streaming ------------------------------------------------------------


@register("stream_ingest", with_(f"{RAW_ROWS}, {DAY} AS ingestion_date FROM raw_interactions", "raw_interactions"))
def stream_ingest(spark, sf):
    """One dated drop per day, some with their columns in another order; the second run finds nothing new."""
    drop, target, checkpoint = (scratch_path(spark, n) for n in ("drop", "raw", "checkpoint"))
    rows = dated(spark, sf)
    days = [r[0] for r in rows.select("ingestion_date").distinct().collect()]
    for n, day in enumerate(sorted(days)):
        own = rows.where(F.col("ingestion_date") == day).drop("ingestion_date")
        files.write_csv(pandas_like(own) if n % 2 else own, f"{drop}/{day}")
        for part in (p for p in listing.list_names(spark, f"{drop}/{day}") if p.endswith(".csv")):
            listing.rename(spark, f"{drop}/{day}/{part}", f"{drop}/{day}/{day}_{part}")
    for _ in range(2):
        streams.ingest_stream(spark, drop, target, checkpoint, INTERACTIONS, once=True).awaitTermination()
    parts = [files.read_partition(spark, target, day, schema=INTERACTIONS).withColumn("ingestion_date", F.lit(day)) for day in sorted(days)]
    return reduce(DataFrame.unionByName, parts)


@register("stream_catalog", with_(f"SELECT *, '20240131' AS ingestion_date FROM ({CATALOG_ROWS})", "raw_catalog"))
def stream_catalog(spark, sf):
    """A first document of half the products, then one of all of them for the same date, each in a run of its own."""
    source, target, checkpoint = (scratch_path(spark, n) for n in ("documents", "api", "checkpoint"))
    rows = X.raw_catalog(spark, sf)
    for n, part in enumerate((rows.where("product_id % 2 = 0"), rows)):
        files.write_catalog_json(part.coalesce(1), f"{source}/{n}", "20240131")
        folder = f"{source}/{n}/ingestion_date=20240131"
        for name in listing.list_names(spark, folder):
            if name.endswith(".json"):
                listing.rename(spark, f"{folder}/{name}", f"{folder}/20240131_{n}_product_catalog.json")
        streams.catalog_stream(spark, source, target, checkpoint, once=True, lines=True).awaitTermination()
    return files.read_catalog_json(spark, f"{target}/ingestion_date=20240131", CATALOG, lines=True).withColumn("ingestion_date", F.lit("20240131"))


@register(
    "stream_feature_update",
    with_(
        """SELECT 'user_features' AS name, count(DISTINCT user_id) AS n, count(*) AS interactions FROM curated
 UNION ALL SELECT 'product_features', count(DISTINCT product_id), count(*) FROM curated
 UNION ALL SELECT 'interaction_features', count(*), sum(interaction_count)::BIGINT FROM interaction_features""",
        "curated", "interaction_features",
    ),
)
def stream_feature_update(spark, sf):
    source, store, checkpoint = (scratch_path(spark, n) for n in ("curated", "store", "checkpoint"))
    cur = stage(spark, sf, "curated")
    # two queries on one store, each with a checkpoint of its own; the first is started again
    for n, part in enumerate((history(cur), new_batch(cur))):
        part.write.parquet(f"{source}/{n}")
        rows = spark.readStream.schema(cur.schema).parquet(f"{source}/{n}")
        for _ in range(2 - n):
            streams.feature_stream(spark, rows, store, f"{checkpoint}/{n}", once=True).awaitTermination()
    return table_sizes(spark, store)


@register("stream_upsert", with_(f"{INTERACTION_ROWS} FROM ({KEEP_LAST})", "curated_old", "curated_new"))
def stream_upsert(spark, sf):
    source, store, checkpoint = (scratch_path(spark, n) for n in ("rows", "store", "checkpoint"))
    keys = ["user_id", "product_id", "interaction_date"]
    cur = stage(spark, sf, "curated")
    for batch in (stage(spark, sf, "interaction_features_old"), features.interaction_features(new_batch(cur))):
        batch.write.mode("append").parquet(source)
        rows = spark.readStream.schema(INTERACTION_FEATURES).parquet(source)
        streams.upsert_stream(spark, rows, store, "rows", keys, ["created_at"], checkpoint, once=True, part="interaction_date").awaitTermination()
    return snapshots.load_snapshot(spark, store, "rows", INTERACTION_FEATURES)
