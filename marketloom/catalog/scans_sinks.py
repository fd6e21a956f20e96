"""Sources and sinks. Each query writes derived rows to the scratch area and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom import fixtures as X
from marketloom.catalog import oracle as O
from marketloom.catalog.base import register
from marketloom.catalog.oracle import r6, when, with_
from marketloom.catalog.stages import history, new_batch, split, stage
from marketloom.operators import quality as Q
from marketloom.plans import curate, evaluate, features, runs
from marketloom.schemas import CATALOG, INTERACTIONS, PRODUCT_FEATURES, USER_FEATURES
from marketloom.session import materialize, scratch_path
from marketloom.sources import files, listing, snapshots

RAW_ROWS = f"SELECT user_id, product_id, event_type, timestamp, {r6('duration_seconds', 'duration_seconds')}"
DAY = "strftime(make_timestamp(timestamp * 1000000), '%Y%m%d')"
CATALOG_ROWS = f"""SELECT product_id, product_name, category_id, category, subcategory_id, subcategory, brand,
 {r6('price', 'price')}, {r6('rating_avg', 'rating_avg')}, rating_count, stock_quantity FROM raw_catalog"""

_roots: dict[tuple[str, str], str] = {}


def dated(spark, sf):
    return X.raw_interactions(spark, sf).withColumn(
        "ingestion_date", F.date_format(F.timestamp_seconds("timestamp"), "yyyyMMdd")
    )


def raw_root(spark, sf):
    """Interactions partitioned by their day, written once per session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _roots:
        path = scratch_path(spark, "raw")
        files.write_partitions(dated(spark, sf), path)
        _roots[key] = path
    return _roots[key]


def pandas_like(df):
    """Columns in another order, one more, and ids written as decimals, as other tools write nullable numbers."""
    return df.select(
        F.lit("x").alias("note"), "timestamp", F.concat(F.col("product_id").cast("string"), F.lit(".0")).alias("product_id"), "event_type", "user_id", "duration_seconds"
    )


@register("scan_csv", with_(f"{RAW_ROWS} FROM raw_interactions", "raw_interactions"))
def scan_csv(spark, sf):
    folder = scratch_path(spark, "drop")
    files.write_csv(pandas_like(X.raw_interactions(spark, sf)), f"{folder}/20240131_user_interactions.csv")
    return files.read_drop(spark, folder, "20240131", "user_interactions", INTERACTIONS)


@register("scan_parquet", with_(f"{RAW_ROWS} FROM raw_interactions WHERE {DAY} = '20240110'", "raw_interactions"))
def scan_parquet(spark, sf):
    return files.read_partition(spark, raw_root(spark, sf), "20240110")


@register("scan_csv_fallback", with_(f"{RAW_ROWS} FROM raw_interactions", "raw_interactions"))
def scan_csv_fallback(spark, sf):
    root = scratch_path(spark, "csv")
    files.write_csv(pandas_like(X.raw_interactions(spark, sf)), f"{root}/ingestion_date=20240131")
    return files.read_partition(spark, root, schema=INTERACTIONS)


def write_document(products, path, envelope):
    """One JSON document with all products, as one file: lines in order, written by one task as they come."""
    rows = materialize(products.withColumn("_at", F.monotonically_increasing_id()), "document")
    first, n = rows.agg(F.min("_at")).scalar(), rows.agg(F.count("*").cast("string")).scalar()
    text = F.to_json(F.struct(*products.columns))
    body = rows.select("_at", F.when(F.col("_at") == first, text).otherwise(F.concat(F.lit(","), text)).alias("value"))
    ends = ((-1, F.concat(F.lit('{"count":'), n, F.lit(',"products":[')), F.lit("]}")) if envelope else (-1, F.lit("["), F.lit("]")))
    one = products.sparkSession.range(1)
    whole = body.unionByName(one.select(F.lit(ends[0]).cast("bigint").alias("_at"), ends[1].alias("value")))
    whole = whole.unionByName(one.select(F.lit(2**63 - 1).alias("_at"), ends[2].alias("value")))
    whole.coalesce(1).sortWithinPartitions("_at").select("value").write.text(path)


@register("scan_json_envelope", with_(CATALOG_ROWS, "raw_catalog"))
def scan_json_envelope(spark, sf):
    """Two documents, however large: even products in an envelope, the others in a bare list."""
    path = scratch_path(spark, "catalog")
    products = X.raw_catalog(spark, sf)
    even = F.coalesce(F.col("product_id") % 2 == 0, F.lit(False))
    write_document(products.where(even), f"{path}/a", True)
    write_document(products.where(~even), f"{path}/b", False)
    return files.read_catalog_json(spark, f"{path}/*", CATALOG)


@register(
    "latest_partition",
    with_(f"{RAW_ROWS} FROM raw_interactions WHERE {DAY} = (SELECT max({DAY}) FROM raw_interactions)", "raw_interactions"),
)
def latest_partition(spark, sf):
    return files.read_partition(spark, raw_root(spark, sf))


@register("scan_all_partitions", with_(f"SELECT DISTINCT * FROM ({RAW_ROWS} FROM raw_interactions)", "raw_interactions"))
def scan_all_partitions(spark, sf):
    return files.read_all_distinct(spark, raw_root(spark, sf))


@register(
    "scan_date_partition",
    with_(f"{RAW_ROWS}, {DAY} AS ingestion_date FROM raw_interactions WHERE {DAY} = '20240120'", "raw_interactions"),
)
def scan_date_partition(spark, sf):
    return files.read_dates(spark, raw_root(spark, sf), date="20240120")


USER_ROWS = f"""SELECT user_id, {r6('age', 'age')}, {r6('age_scaled', 'age_scaled')}, location_city, location_country, tier, interaction_count,
 {r6('activity_frequency', 'activity_frequency')}, {r6('purchase_ratio', 'purchase_ratio')},
 {when('first_interaction', 'first_interaction')}, {when('last_interaction', 'last_interaction')}, preferred_category,
 {r6('category_confidence', 'category_confidence')}, {when('created_at', 'created_at')}, {when('updated_at', 'updated_at')}"""
_P = ["price", "price_scaled", "rating_avg", "rating_count_log", "stock_quantity_scaled", "popularity_score", "conversion_rate", "diversity_score"]
PRODUCT_ROWS = f"""SELECT product_id, category_id, category, subcategory_id, subcategory, brand, rating_count, interaction_count, unique_users,
 {', '.join(r6(c, c) for c in _P)}, {when('created_at', 'created_at')}, {when('updated_at', 'updated_at')}"""
_I = ["implicit_score", "hour_sin", "hour_cos", "day_sin", "day_cos", "duration_scaled"]
INTERACTION_ROWS = f"""SELECT user_id, product_id, interaction_count, {', '.join(r6(c, c) for c in _I)}, time_since_last_seconds,
 strftime(interaction_date, '%Y-%m-%d') AS interaction_date, {when('created_at', 'created_at')}"""


@register("load_snapshot", with_(f"{USER_ROWS} FROM user_features", "user_features"))
def load_snapshot(spark, sf):
    """An absent snapshot is an empty frame; after a commit it is the committed table."""
    root = scratch_path(spark, "store")
    before = snapshots.load_snapshot(spark, root, "user_features", USER_FEATURES)
    snapshots.save_snapshots(spark, root, {"user_features": stage(spark, sf, "user_features")}, {"full": ""})
    return before.unionByName(snapshots.load_snapshot(spark, root, "user_features", USER_FEATURES))


@register("latest_source_file", "SELECT strftime(max(ts), '%Y%m%d') AS latest_date FROM events")
def latest_source_file(spark, sf):
    """One drop per day of events; the newest is found by its name."""
    folder, suffix = scratch_path(spark, "drops"), "_user_interactions.csv"
    X.table(spark, sf, "events").select("event_id", F.date_format("ts", "yyyyMMdd").alias("day")).write.partitionBy("day").csv(folder)
    for name in listing.list_names(spark, folder):
        if name.startswith("day="):
            listing.rename(spark, f"{folder}/{name}", f"{folder}/{name[4:]}{suffix}")
    newest = files.latest_source_file(spark, folder, suffix)
    return files.latest_source_date(spark.read.csv(f"{folder}/{newest}"), F.lit(newest))


@register(
    "scan_runs",
    with_(
        f"SELECT run_id, status, {when('start_time', 'start_time')}, {when('end_time', 'end_time')}, {r6('c_hr', 'hit_rate')}, model_type FROM raw_runs",
        "raw_runs",
    ),
)
def scan_runs(spark, sf):
    path = scratch_path(spark, "ledger")
    ledger = X.raw_runs(spark, sf)
    runs.append_runs(ledger.where("status = 'FINISHED'"), path)
    runs.append_runs(ledger.where("status <> 'FINISHED'"), path)
    return runs.scan_runs(spark, path).select(
        "run_id", "status", "start_time", "end_time", runs.metric("content_hit_rate_50").alias("hit_rate"), runs.param("model_type").alias("model_type")
    )


@register(
    "entity_sample",
    with_(f"{INTERACTION_ROWS} FROM interaction_features ORDER BY interaction_features.user_id, interaction_features.product_id, interaction_features.interaction_date LIMIT 2", "interaction_features"),
)
def entity_sample(spark, sf):
    return stage(spark, sf, "interaction_features").orderBy("user_id", "product_id", "interaction_date").limit(2)


# --- sinks ----------------------------------------------------------------


@register("sink_partitioned_parquet", with_(f"{RAW_ROWS}, {DAY} AS ingestion_date FROM raw_interactions", "raw_interactions"))
def sink_partitioned_parquet(spark, sf):
    """Writing the later half again replaces only its own partitions."""
    path = scratch_path(spark, "sink")
    rows = dated(spark, sf)
    files.write_partitions(rows, path)
    files.write_partitions(rows.where("ingestion_date >= '20240115'"), path)
    return files.read_dates(spark, path)


@register("sink_json", with_(CATALOG_ROWS, "raw_catalog"))
def sink_json(spark, sf):
    root = scratch_path(spark, "api")
    files.write_catalog_json(X.raw_catalog(spark, sf), root, "20240131")
    return files.read_catalog_json(spark, f"{root}/ingestion_date=20240131", CATALOG, lines=True)


_C = ["duration_seconds", "hour_norm", "day_norm", "duration_scaled", "age", "age_scaled", "price", "rating_avg", "price_scaled", "stock_quantity_scaled", "rating_count_log"]
_PLAIN = [
    "user_id", "product_id", "event_type", "timestamp", "event_strength", "hour_of_day", "day_of_week", "location_city", "location_country",
    "tier", "tier_basic", "tier_premium", "product_name", "category_id", "category", "subcategory_id", "subcategory", "brand", "rating_count",
    "stock_quantity", *[f"cat_{c}" for c in O.CATEGORIES], *[f"subcat_{c}" for c in O.SUBCATEGORIES],
]
CURATED_ROWS = f"SELECT {', '.join(_PLAIN)}, {', '.join(r6(c, c) for c in _C)}, {when('dt', 'dt')} FROM curated"


@register("sink_curated", with_(CURATED_ROWS.replace(" FROM curated", ", '20240131' AS event_date FROM curated"), "curated"))
def sink_curated(spark, sf):
    root = scratch_path(spark, "curated")
    files.write_date(stage(spark, sf, "curated"), root, "20240131", "event_date")
    return files.read_dates(spark, root, "event_date", "20240131")


@register(
    "lineage_record",
    with_(
        """SELECT '20240131' AS event_date, '2025-01-01 00:00:00' AS created_at, count(*) AS row_count, 46::BIGINT AS n_columns, 'user_interactions' AS source,
 '20240131' AS ingestion_date, 'curate_interactions>curate_profiles>curate_catalog>merge_curated' AS steps FROM curated""",
        "curated",
    ),
)
def lineage_record(spark, sf):
    from pyspark.sql import Observation

    root = scratch_path(spark, "lineage")
    seen = Observation("rows")
    df = stage(spark, sf, "curated")
    files.write_date(df.observe(seen, F.count(F.lit(1)).alias("rows")), root, "20240131", "event_date")
    record = curate.lineage_record(
        spark, "20240131", features.stamp("2025-01-01"), {"user_interactions": ("20240131", root)}, df.columns, seen.get["rows"]
    )
    return record.select(
        "event_date", "created_at", "row_count", F.size("columns").alias("n_columns"),
        F.explode("sources").alias("source", "_s"), F.array_join("transformations", ">").alias("steps"),
    ).select("event_date", "created_at", "row_count", "n_columns", "source", "_s.ingestion_date", "steps")


NEW_PRODUCTS = O.finish_products(
    O.merged(
        f"SELECT * FROM ({O.products_of('curated_old')})", O.products_of("curated_new"), "product_id",
        ["interaction_count", "unique_users", "purchases"], O.PRODUCT_ATTRIBUTES,
    )
)


@register("sink_feature_snapshot", with_(f"{PRODUCT_ROWS} FROM ({NEW_PRODUCTS})", "curated_old", "curated_new"))
def sink_feature_snapshot(spark, sf):
    """The second version is computed from the first one and replaces it."""
    root = scratch_path(spark, "store")
    cur = stage(spark, sf, "curated")
    snapshots.save_snapshots(spark, root, {"product_features": features.product_features(history(cur))}, {"day-1": ""})
    stored = snapshots.load_snapshot(spark, root, "product_features", PRODUCT_FEATURES)
    snapshots.save_snapshots(spark, root, {"product_features": features.update_products(stored, new_batch(cur))}, {"day-1": "", "day-2": ""})
    return snapshots.load_snapshot(spark, root, "product_features", PRODUCT_FEATURES)


@register(
    "sink_recs_csv",
    with_(f"SELECT user_id, product_id, {r6('score', 'score')} FROM content_recs WHERE user_id IN (SELECT DISTINCT user_id FROM train ORDER BY 1 LIMIT 5)", "content_recs", "train"),
)
def sink_recs_csv(spark, sf):
    path = scratch_path(spark, "recs")
    sample = evaluate.sample_users(split(spark, sf)[0], 5)
    recs = stage(spark, sf, "content_recs").join(sample, "user_id", "left_semi")
    files.write_csv(recs.select("user_id", "product_id", "score"), path)
    return spark.read.schema("user_id BIGINT, product_id BIGINT, score DOUBLE").option("header", True).csv(path)


def all_reports(spark, sf):
    report = Q.suite_report(X.raw_interactions(spark, sf), "user_interactions")
    report = report.unionByName(Q.suite_report(X.raw_profiles(spark, sf), "user_profiles"))
    return report.unionByName(Q.suite_report(X.raw_catalog(spark, sf), "product_catalog"))


