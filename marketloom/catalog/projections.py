"""Projections, filters, predicates and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom import fixtures as X
from marketloom.catalog import oracle as O
from marketloom.catalog.base import register
from marketloom.catalog.oracle import r6, when, with_
from marketloom.catalog.scans_sinks import INTERACTION_ROWS, RAW_ROWS
from marketloom.catalog.stages import stage
from marketloom.functions import scalars as S
from marketloom.functions import vectors as V
from marketloom.operators import aggregates as A
from marketloom.operators import cleaning as C
from marketloom.operators import scaling as M
from marketloom.plans import features, runs
from marketloom.schemas import EVENT_TYPES, INTERACTION_FEATURES

RAW = "raw_interactions"
# id texts in every shape the lenient cast must read
ID_TEXT_SQL = """CASE event_id % 6 WHEN 0 THEN user_id || '.7' WHEN 1 THEN 'x' || user_id WHEN 2 THEN ' ' || user_id || ' '
 WHEN 3 THEN '-' || user_id || '.7' WHEN 4 THEN user_id || 'e1' ELSE NULL END"""


@register("drop_null_keys", with_(f"{RAW_ROWS} FROM raw_interactions WHERE user_id IS NOT NULL AND product_id IS NOT NULL", RAW))
def drop_null_keys(spark, sf):
    return C.drop_null_keys(X.raw_interactions(spark, sf), "user_id", "product_id")


@register(
    "fill_defaults",
    with_(
        f"SELECT user_id, coalesce(product_id, -1) AS product_id, coalesce(event_type, 'Unknown') AS event_type, timestamp, {r6('coalesce(duration_seconds, 0)', 'duration_seconds')} FROM raw_interactions",
        RAW,
    ),
)
def fill_defaults(spark, sf):
    return C.fill_defaults(
        X.raw_interactions(spark, sf), {"duration_seconds": 0, "product_id": -1, "event_type": "Unknown", "absent": 1}
    )


@register(
    "median_impute",
    with_(f"SELECT user_id, {r6('coalesce(age, median(age) OVER ())', 'age')} FROM raw_profiles", "raw_profiles"),
)
def median_impute(spark, sf):
    return M.impute_medians(X.raw_profiles(spark, sf), "age").select("user_id", "age")


@register(
    "tolerant_cast",
    f"""SELECT event_id, coalesce(try_cast(trunc(try_cast(trim({ID_TEXT_SQL}) AS DOUBLE)) AS BIGINT), 0) AS id,
 coalesce(try_cast(trunc(value) AS BIGINT), 0) AS whole FROM events""",
)
def tolerant_cast(spark, sf):
    texts = X.table(spark, sf, "events").selectExpr("event_id", f"{ID_TEXT_SQL} AS id", "value AS whole")
    return C.tolerant_ids(texts, "id", "whole")


@register(
    "align_schema",
    with_(
        f"""SELECT user_id, coalesce(product_id, 0) AS product_id, 0::BIGINT AS interaction_count, 0.0e0 AS implicit_score, 0.0e0 AS hour_sin,
 0.0e0 AS hour_cos, 0.0e0 AS day_sin, 0.0e0 AS day_cos, {r6('coalesce(duration_seconds, 0)', 'duration_scaled')}, 0::BIGINT AS time_since_last_seconds,
 NULL::VARCHAR AS interaction_date, NULL::VARCHAR AS created_at FROM raw_interactions""",
        RAW,
    ),
)
def align_schema(spark, sf):
    raw = X.raw_interactions(spark, sf).withColumnRenamed("duration_seconds", "duration_scaled")
    return C.align_schema(raw, INTERACTION_FEATURES)


VALID_SET = "event_type IN ('view', 'click', 'add_to_cart', 'purchase')"


@register(
    "pred_in_set",
    with_(
        f"SELECT count(*) FILTER ({VALID_SET}) AS valid, count(*) FILTER (NOT coalesce({VALID_SET}, false)) AS invalid FROM raw_interactions",
        RAW,
    ),
)
def pred_in_set(spark, sf):
    inside = F.coalesce(F.col("event_type").isin(*EVENT_TYPES), F.lit(False))
    return X.raw_interactions(spark, sf).agg(F.count_if(inside).alias("valid"), F.count_if(~inside).alias("invalid"))


@register(
    "pred_between",
    with_(
        """SELECT count(*) FILTER (NOT coalesce(duration_seconds BETWEEN 0 AND 50, false)) AS invalid_duration,
 count(*) FILTER (NOT coalesce(product_id BETWEEN 0 AND 89, false)) AS invalid_product FROM raw_interactions""",
        RAW,
    ),
)
def pred_between(spark, sf):
    def outside(column, low, high):
        return F.count_if(~F.coalesce(F.col(column).between(low, high), F.lit(False)))

    return X.raw_interactions(spark, sf).agg(
        outside("duration_seconds", 0, 50).alias("invalid_duration"), outside("product_id", 0, 89).alias("invalid_product")
    )


@register(
    "pred_compare_nulls",
    with_(
        """SELECT count(*) FILTER (price <= 950) AS low_prices, count(*) FILTER (rating_avg < 2 OR rating_avg > 4) AS far_ratings,
 count(*) FILTER (stock_quantity < 10) AS low_stock FROM raw_catalog""",
        "raw_catalog",
    ),
)
def pred_compare_nulls(spark, sf):
    return X.raw_catalog(spark, sf).agg(
        F.count_if(F.col("price") <= 950).alias("low_prices"),
        F.count_if((F.col("rating_avg") < 2) | (F.col("rating_avg") > 4)).alias("far_ratings"),
        F.count_if(F.col("stock_quantity") < 10).alias("low_stock"),
    )


@register(
    "purchase_mask",
    with_(
        f"""SELECT product_id, count(*) FILTER (event_type = 'purchase') AS by_type, count(*) FILTER ({O.STRENGTH} = 4) AS by_strength,
 0::BIGINT AS by_nothing FROM raw_interactions WHERE product_id IS NOT NULL GROUP BY 1""",
        RAW,
    ),
)
def purchase_mask(spark, sf):
    raw = C.drop_null_keys(X.raw_interactions(spark, sf), "product_id")
    coded = raw.withColumn("event_strength", S.event_strength(F.col("event_type")))
    return coded.groupBy("product_id").agg(
        F.count_if(S.purchase_mask(raw)).alias("by_type"),
        F.count_if(S.purchase_mask(coded.drop("event_type"))).alias("by_strength"),
        F.count_if(S.purchase_mask(raw.select("product_id"))).alias("by_nothing"),
    )


@register(
    "strip_prefix_names",
    with_(f"SELECT user_id, {r6('age', 'age')}, tier FROM user_features", "user_features"),
)
def strip_prefix_names(spark, sf):
    users = stage(spark, sf, "user_features")
    return C.strip_view_prefix(
        users.select("user_id", F.col("age").alias("user_features__age"), F.col("tier").alias("user_features__tier"))
    )


@register(
    "id_to_string",
    with_("SELECT user_id::VARCHAR AS user_id, product_id::VARCHAR AS product_id, event_type FROM raw_interactions", RAW),
)
def id_to_string(spark, sf):
    return C.id_to_string(X.raw_interactions(spark, sf), "user_id", "product_id").select("user_id", "product_id", "event_type")


@register(
    "audit_columns",
    with_(
        """SELECT user_id, age, '2025-03-01 00:00:00' AS created_at, '2025-03-01 00:00:00' AS updated_at,
 '2025-01-01 00:00:00' AS event_timestamp FROM raw_profiles""",
        "raw_profiles",
    ),
)
def audit_columns(spark, sf):
    profiles = X.raw_profiles(spark, sf).select("user_id", "age")
    stamped = C.with_audit(profiles, features.stamp("2025-03-01"))
    return stamped.withColumn("event_timestamp", features.stamp("2025-01-01"))


@register("drop_helpers", with_(f"{INTERACTION_ROWS.replace(', interaction_count', '', 1)} FROM interaction_features", "interaction_features"))
def drop_helpers(spark, sf):
    return stage(spark, sf, "interaction_features").drop("interaction_count", "avg_ts")


@register(
    "filter_runs",
    with_(f"SELECT run_id, {r6('c_hr', 'hit_rate')} FROM raw_runs WHERE status = 'FINISHED' AND c_hr > 0", "raw_runs"),
)
def filter_runs(spark, sf):
    kept = runs.with_positive(runs.finished(X.raw_runs(spark, sf)))
    return kept.select("run_id", runs.metric("content_hit_rate_50").alias("hit_rate"))


# --- scalar functions -----------------------------------------------------


@register("event_strength", with_(f"SELECT event_type, {O.STRENGTH} AS event_strength, count(*) AS n FROM raw_interactions GROUP BY ALL", RAW))
def event_strength(spark, sf):
    strength = S.event_strength(F.col("event_type")).alias("event_strength")
    return X.raw_interactions(spark, sf).groupBy("event_type", strength).agg(A.rows().alias("n"))


TS = "make_timestamp(timestamp * 1000000)"


@register("epoch_to_ts", with_(f"SELECT timestamp, {when(TS, 'dt')} FROM raw_interactions", RAW))
def epoch_to_ts(spark, sf):
    return X.raw_interactions(spark, sf).select("timestamp", S.epoch_to_ts(F.col("timestamp")).alias("dt"))


@register("hour_weekday", with_(f"SELECT timestamp, hour({TS}) AS hour_of_day, isodow({TS}) - 1 AS day_of_week FROM raw_interactions", RAW))
def hour_weekday(spark, sf):
    dt = S.epoch_to_ts(F.col("timestamp"))
    return X.raw_interactions(spark, sf).select("timestamp", F.hour(dt).alias("hour_of_day"), F.weekday(dt).alias("day_of_week"))


@register(
    "time_norm",
    with_(f"SELECT timestamp, {r6(f'hour({TS}) / 23.0e0', 'hour_norm')}, {r6(f'(isodow({TS}) - 1) / 6.0e0', 'day_norm')} FROM raw_interactions", RAW),
)
def time_norm(spark, sf):
    dt = S.epoch_to_ts(F.col("timestamp"))
    return X.raw_interactions(spark, sf).select(
        "timestamp", S.hour_norm(F.hour(dt)).alias("hour_norm"), S.weekday_norm(F.weekday(dt)).alias("day_norm")
    )


def _circle(f, part, period, name):
    return r6(f"{f}(2 * pi() * {part} / {period})", name)


@register(
    "cyclic_time",
    with_(
        f"""SELECT timestamp, {_circle('sin', f'hour({TS})', 24, 'hour_sin')}, {_circle('cos', f'hour({TS})', 24, 'hour_cos')},
 {_circle('sin', f'(isodow({TS}) - 1)', 7, 'day_sin')}, {_circle('cos', f'(isodow({TS}) - 1)', 7, 'day_cos')} FROM raw_interactions""",
        RAW,
    ),
)
def cyclic_time(spark, sf):
    dt = S.epoch_to_ts(F.col("timestamp"))
    (hs, hc), (ds, dc) = S.cyclic(F.hour(dt), 24), S.cyclic(F.weekday(dt), 7)
    return X.raw_interactions(spark, sf).select(
        "timestamp", hs.alias("hour_sin"), hc.alias("hour_cos"), ds.alias("day_sin"), dc.alias("day_cos")
    )


@register(
    "min_max_scale",
    with_(
        f"""SELECT product_id, {r6(O.mm('price', 'min(price) OVER ()', 'max(price) OVER ()'), 'price_scaled')},
 {r6(O.mm('one', 'min(one) OVER ()', 'max(one) OVER ()'), 'one_scaled')} FROM (SELECT *, 5 AS one FROM raw_catalog)""",
        "raw_catalog",
    ),
)
def min_max_scale(spark, sf):
    catalog = X.raw_catalog(spark, sf).withColumn("one", F.lit(5))
    return M.min_max_scale(catalog, {"price": "price_scaled", "one": "one_scaled"}).select("product_id", "price_scaled", "one_scaled")


@register("log1p", with_(f"SELECT product_id, {r6('ln(1 + coalesce(rating_count, 0))', 'rating_count_log')} FROM raw_catalog", "raw_catalog"))
def log1p(spark, sf):
    return X.raw_catalog(spark, sf).select("product_id", F.log1p(F.coalesce("rating_count", F.lit(0)).cast("double")).alias("rating_count_log"))


@register("one_hot", with_(f"SELECT product_id, category, {O.HOT.split(', (coalesce(subcategory')[0]} FROM raw_catalog", "raw_catalog"))
def one_hot(spark, sf):
    return M.one_hot(X.raw_catalog(spark, sf).select("product_id", "category"), "category", "cat")


@register("ts_to_date", with_(f"SELECT strftime({TS}, '%Y-%m-%d') AS day, count(*) AS n FROM raw_interactions GROUP BY 1", RAW))
def ts_to_date(spark, sf):
    day = F.to_date(S.epoch_to_ts(F.col("timestamp"))).alias("day")
    return X.raw_interactions(spark, sf).groupBy(day).agg(A.rows().alias("n"))


@register(
    "activity_frequency",
    with_(
        f"""SELECT user_id, {r6('count(*) / (CASE WHEN max(timestamp) = min(timestamp) THEN 1.0e0 ELSE (max(timestamp) - min(timestamp)) / 86400.0e0 END)', 'frequency')}
 FROM raw_order_interactions GROUP BY 1""",
        "raw_order_interactions",
    ),
)
def activity_frequency(spark, sf):
    spans = X.raw_order_interactions(spark, sf).groupBy("user_id").agg(
        A.rows().alias("n"), F.min("timestamp").alias("a"), F.max("timestamp").alias("b")
    )
    days = S.days_between(S.epoch_to_ts(F.col("a")), S.epoch_to_ts(F.col("b")))
    return spans.select("user_id", (F.col("n") / days).alias("frequency"))


@register(
    "strip_onehot_prefix",
    with_("SELECT product_id, 'cat_' || category AS name, category AS plain FROM raw_catalog", "raw_catalog"),
)
def strip_onehot_prefix(spark, sf):
    named = X.raw_catalog(spark, sf).select("product_id", F.concat(F.lit("cat_"), "category").alias("name"))
    return named.withColumn("plain", S.strip_prefix(F.col("name"), "cat_"))


@register(
    "regex_match",
    with_(
        """SELECT location_country, count(*) AS n,
 count(*) FILTER (NOT regexp_full_match(trim(location_country), '[A-Za-z]+')) AS invalid FROM raw_profiles GROUP BY 1""",
        "raw_profiles",
    ),
)
def regex_match(spark, sf):
    return X.raw_profiles(spark, sf).groupBy("location_country").agg(
        A.rows().alias("n"), F.count_if(S.not_letters(F.col("location_country"))).alias("invalid")
    )


@register("round2", with_("SELECT round(avg(price), 2) + 0.0e0 AS avg_price, round(avg(rating_avg), 2) + 0.0e0 AS avg_rating FROM raw_catalog", "raw_catalog"))
def round2(spark, sf):
    return X.raw_catalog(spark, sf).agg(F.bround(F.avg("price"), 2).alias("avg_price"), F.bround(F.avg("rating_avg"), 2).alias("avg_rating"))


@register("date_parse", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS parsed, strftime(ts, '%Y%m%d') AS formatted FROM events")
def date_parse(spark, sf):
    text = X.table(spark, sf, "events").select("event_id", F.date_format("ts", "yyyyMMdd").alias("t"))
    parsed = S.parse_day(F.col("t"))
    return text.select("event_id", parsed.alias("parsed"), S.format_day(parsed).alias("formatted"))


@register("split_prefix", "SELECT strftime(ts, '%Y%m%d') AS prefix, count(*) AS n FROM events GROUP BY 1")
def split_prefix(spark, sf):
    name = F.concat(F.date_format("ts", "yyyyMMdd"), F.lit("_user_"), "event_type", F.lit(".csv"))
    return X.table(spark, sf, "events").groupBy(S.before_underscore(name).alias("prefix")).agg(A.rows().alias("n"))


@register(
    "label_title",
    with_(
        """SELECT event_type, list_aggregate(list_transform(string_split(event_type, '_'), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ') AS label
 FROM (SELECT DISTINCT event_type FROM raw_interactions)""",
        RAW,
    ),
)
def label_title(spark, sf):
    kinds = X.raw_interactions(spark, sf).select("event_type").distinct()
    return kinds.withColumn("label", S.metric_label(F.col("event_type")))


@register(
    "metric_text",
    with_("SELECT run_id, CASE WHEN c_hr IS NULL THEN 'N/A' ELSE printf('%.4f', c_hr) END AS shown FROM raw_runs", "raw_runs"),
)
def metric_text(spark, sf):
    return X.raw_runs(spark, sf).select("run_id", S.metric_text(runs.metric("content_hit_rate_50")).alias("shown"))


@register(
    "run_duration",
    with_("SELECT run_id, coalesce((epoch(end_time)::BIGINT - epoch(start_time)::BIGINT) || 's', 'Running') AS duration FROM raw_runs", "raw_runs"),
)
def run_duration(spark, sf):
    return X.raw_runs(spark, sf).select("run_id", S.run_duration(F.col("start_time"), F.col("end_time")).alias("duration"))


@register(
    "strip_metric_prefix",
    with_(
        " UNION ALL ".join(
            f"SELECT run_id, '{name}' AS metric, {r6(c, 'value')} FROM raw_runs WHERE {c} IS NOT NULL"
            for name, c in (("content_hit_rate_50", "c_hr"), ("content_precision_50", "c_pr"), ("svd_hit_rate_50", "s_hr"), ("svd_precision_50", "s_pr"))
        ),
        "raw_runs",
    ),
)
def strip_metric_prefix(spark, sf):
    return runs.plain_maps(X.raw_runs(spark, sf)).select("run_id", F.explode("metrics").alias("metric", "value"))


NEIGHBOUR = "JOIN embeddings b ON b.vec_id = a.vec_id + 1"


@register("dot_product", f"SELECT a.vec_id, round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 4) + 0.0e0 AS dot FROM embeddings a {NEIGHBOUR}")
def dot_product(spark, sf):
    return _pairs(spark, sf).select("vec_id", F.round(V.dot(F.col("embedding"), F.col("other")), 4).alias("dot"))


@register(
    "cosine_similarity",
    f"""SELECT a.vec_id, round(CASE WHEN n.z THEN 0.0e0 ELSE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) END, 5) + 0.0e0 AS cosine
 FROM embeddings a {NEIGHBOUR} CROSS JOIN (VALUES (false), (true)) n(z)""",
)
def cosine_similarity(spark, sf):
    """Each neighbouring pair, and each vector against an all-zero one (0)."""
    pairs = _pairs(spark, sf)
    zero = F.transform("other", lambda x: x * 0)
    real = pairs.select("vec_id", F.round(V.cosine(F.col("embedding"), F.col("other")), 5).alias("cosine"))
    return real.unionByName(pairs.select("vec_id", V.cosine(F.col("embedding"), zero).alias("cosine")))


def _pairs(spark, sf):
    vectors = X.table(spark, sf, "embeddings").select("vec_id", "embedding")
    other = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return vectors.join(other, "vec_id")


@register(
    "iso_to_ts",
    """SELECT event_id, strftime(CASE event_id % 5 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts) WHEN 2 THEN date_trunc('day', ts)
 WHEN 3 THEN date_trunc('second', ts) - INTERVAL 2 HOUR ELSE NULL END, '%Y-%m-%d %H:%M:%S') AS parsed FROM events""",
)
def iso_to_ts(spark, sf):
    """Texts with T or blank, with zone offset, date only, and unreadable."""
    def text(pattern):
        return F.date_format("ts", pattern)

    kind = F.col("event_id") % 5
    mixed = (
        F.when(kind == 0, F.concat(text("yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
        .when(kind == 1, text("yyyy-MM-dd HH:mm:ss.SSS"))
        .when(kind == 2, text("yyyy-MM-dd"))
        .when(kind == 3, F.concat(text("yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
        .otherwise(F.lit("soon"))
    )
    return X.table(spark, sf, "events").select("event_id", S.iso_to_ts(mixed).alias("parsed"))


