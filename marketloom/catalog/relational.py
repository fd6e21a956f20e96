"""Joins, aggregates, windows, sorts and set operations."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from marketloom import fixtures as X
from marketloom.catalog import oracle as O
from marketloom.catalog.base import register
from marketloom.catalog.oracle import r6, when, with_
from marketloom.catalog.scans_sinks import INTERACTION_ROWS, RAW_ROWS
from marketloom.catalog.stages import history, new_batch, split, stage
from marketloom.functions import scalars as S
from marketloom.operators import aggregates as A
from marketloom.operators import cleaning as C
from marketloom.operators import joins as J
from marketloom.operators import scaling as M
from marketloom.operators import scoring
from marketloom.operators import windows as W
from marketloom.plans import content, eda, evaluate, features, runs
from marketloom.schemas import PRODUCT_VIEW, USER_VIEW

RAW, ORDERS = "raw_interactions", "raw_order_interactions"
DAY_MICROS = 86_400_000_000

# --- joins ----------------------------------------------------------------


@register(
    "left_join_profiles",
    with_("SELECT r.user_id, product_id, timestamp, age, tier, location_city FROM raw_interactions r LEFT JOIN raw_profiles p ON r.user_id = p.user_id", RAW, "raw_profiles"),
)
def left_join_profiles(spark, sf):
    joined = J.left_join(X.raw_interactions(spark, sf), X.raw_profiles(spark, sf), "user_id", "_profile")
    return joined.select("user_id", "product_id", "timestamp", "age", "tier", "location_city")


@register(
    "left_join_catalog",
    with_(
        f"""SELECT r.product_id, r.user_id, r.event_type, c.brand, c.event_type AS event_type_catalog, {r6('c.price', 'price')}
 FROM raw_interactions r LEFT JOIN (SELECT *, category AS event_type FROM raw_catalog) c ON r.product_id = c.product_id""",
        RAW, "raw_catalog",
    ),
)
def left_join_catalog(spark, sf):
    """The catalog gets a clashing column on purpose, to show the suffix."""
    catalog = X.raw_catalog(spark, sf).withColumn("event_type", F.col("category"))
    joined = J.left_join(X.raw_interactions(spark, sf), catalog, "product_id", "_catalog")
    return joined.select("product_id", "user_id", "event_type", "brand", "event_type_catalog", "price")


@register(
    "eda_left_joins",
    with_(
        f"""SELECT i.user_id, i.product_id, i.timestamp, {r6('p.age', 'age')}, {r6('c.price', 'price')}, c.product_name FROM cur_interactions i
 LEFT JOIN raw_profiles p ON i.user_id = p.user_id LEFT JOIN raw_catalog c ON i.product_id = c.product_id""",
        "cur_interactions", "raw_profiles", "raw_catalog",
    ),
)
def eda_left_joins(spark, sf):
    df = eda.eda_interactions(X.raw_interactions(spark, sf))
    df = J.left_join(df, X.raw_profiles(spark, sf), "user_id", "_y")
    df = J.left_join(df, X.raw_catalog(spark, sf), "product_id", "_y")
    return df.select("user_id", "product_id", "timestamp", F.col("age").cast("double"), "price", "product_name")


@register(
    "asof_join",
    f"""WITH f AS (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'view' GROUP BY ALL),
 e AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase')
 SELECT event_id, e.user_id, CASE WHEN e.ts - f.ts <= INTERVAL 1 DAY THEN {r6('f.value')} END AS value,
 CASE WHEN e.ts - f.ts <= INTERVAL 1 DAY THEN {when('f.ts')} END AS feature_timestamp
 FROM e ASOF LEFT JOIN f ON e.user_id = f.user_id AND e.ts >= f.ts""",
)
def asof_join(spark, sf):
    """Newest view of the user within a day before each purchase."""
    events = X.table(spark, sf, "events")
    views = events.where("event_type = 'view'").select("user_id", "ts", "value")
    purchases = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return J.asof_join(purchases, views, ["user_id"], ["value"], DAY_MICROS, "ts", "ts").drop("ts")


@register(
    "semi_join_catalog",
    with_(f"{RAW_ROWS} FROM raw_interactions WHERE product_id IN (SELECT product_id FROM raw_catalog)", RAW, "raw_catalog"),
)
def semi_join_catalog(spark, sf):
    return J.semi_join(X.raw_interactions(spark, sf), X.raw_catalog(spark, sf), "product_id")


@register(
    "anti_join_seen",
    with_("SELECT DISTINCT user_id, product_id FROM test ANTI JOIN train USING (user_id, product_id)", "train", "test"),
)
def anti_join_seen(spark, sf):
    """Held-out pairs that do not occur in training."""
    train, test = split(spark, sf)
    return J.anti_join(content.seen_pairs(test), content.seen_pairs(train), "user_id", "product_id")


@register(
    "reindex_fill_zero",
    with_("SELECT user_id, count(*) FILTER (event_type = 'purchase') AS purchases FROM raw_order_interactions GROUP BY 1", ORDERS),
)
def reindex_fill_zero(spark, sf):
    raw = X.raw_order_interactions(spark, sf)
    some = A.count_by_key(raw.where("event_type = 'purchase'"), "user_id").withColumnRenamed("n", "purchases")
    return J.realign_to_keys(raw, some, "user_id", "purchases")


HITS = """SELECT t.user_id, count(*) AS actual, count(r.product_id) AS hits
 FROM (SELECT DISTINCT user_id, product_id FROM test WHERE user_id IN (SELECT user_id FROM user_profiles_cb)) t
 LEFT JOIN content_recs r ON t.user_id = r.user_id AND t.product_id = r.product_id GROUP BY 1"""


@register("rec_hits", with_(HITS, "test", "content_recs", "user_profiles_cb"))
def rec_hits(spark, sf):
    known = content.known_users(stage(spark, sf, "user_profiles_cb"))
    return evaluate.hits_per_user(stage(spark, sf, "content_recs"), split(spark, sf)[1], known)


@register(
    "cross_score",
    with_(
        f"SELECT user_id, count(*) AS n_items, {r6('max(score)', 'best_score')}, {r6('avg(score)', 'mean_score')} FROM content_scores GROUP BY 1",
        "content_scores",
    ),
)
def cross_score(spark, sf):
    """Every user scored against every item; the pairs themselves never become rows."""
    users = scoring.pack_vectors(stage(spark, sf, "user_profiles_cb"), "user_id")
    items = scoring.pack_vectors(stage(spark, sf, "item_vectors"), "product_id")
    return scoring.score_summary(users, items, cosine=True)


@register(
    "online_lookup",
    with_(
        f"""SELECT k.user_id, k.product_id, trunc(u.age)::BIGINT AS age, location_city, category, {r6('price::FLOAT', 'price')}
 FROM (SELECT DISTINCT user_id, product_id FROM raw_interactions WHERE product_id IS NOT NULL) k
 LEFT JOIN user_features u ON k.user_id = u.user_id LEFT JOIN (
 SELECT * REPLACE (CASE WHEN product_id % 2 <> 0 THEN product_id + 1000000000 ELSE product_id END AS product_id) FROM product_features) p ON k.product_id = p.product_id""",
        RAW, "user_features", "product_features",
    ),
)
def online_lookup(spark, sf):
    """The store knows odd products under other keys, so they are not found."""
    keys = C.drop_null_keys(X.raw_interactions(spark, sf), "product_id").select("user_id", "product_id").distinct()
    users = stage(spark, sf, "user_features").withColumn("event_timestamp", features.stamp("2025-01-01"))
    products = stage(spark, sf, "product_features").withColumn("event_timestamp", features.stamp("2025-01-01"))
    found = J.online_lookup(keys, users, USER_VIEW, ["age", "location_city"])
    return J.online_lookup(found, products.withColumn("product_id", X.aside("product_id", "product_id % 2 <> 0")), PRODUCT_VIEW, ["category", "price"])


# --- aggregates -----------------------------------------------------------


@register(
    "count_by_key",
    with_("SELECT user_id, product_id, count(*) AS n FROM raw_interactions WHERE product_id IS NOT NULL GROUP BY 1, 2", RAW),
)
def count_by_key(spark, sf):
    return A.count_by_key(X.raw_interactions(spark, sf), "user_id", "product_id")


@register(
    "min_max_ts",
    with_("SELECT user_id, min(timestamp) AS first_at, max(timestamp) AS last_at, (SELECT max(timestamp) FROM raw_interactions) AS overall FROM raw_interactions GROUP BY 1", RAW),
)
def min_max_ts(spark, sf):
    raw = X.raw_interactions(spark, sf)
    spans = raw.groupBy("user_id").agg(F.min("timestamp").alias("first_at"), F.max("timestamp").alias("last_at"))
    return spans.withColumn("overall", raw.agg(F.max("timestamp")).scalar())


@register(
    "sum_by_key",
    with_(
        f"SELECT category, sum(coalesce(stock_quantity, 0))::BIGINT AS stock, {r6('coalesce(sum(price) FILTER (price < 0), 0)', 'nothing')} FROM raw_catalog GROUP BY 1",
        "raw_catalog",
    ),
)
def sum_by_key(spark, sf):
    """The second sum has no non-null input: 0, not null."""
    return X.raw_catalog(spark, sf).groupBy("category").agg(
        A.sum_or_zero(F.col("stock_quantity")).alias("stock"),
        A.sum_or_zero(F.when(F.col("price") < 0, F.col("price"))).alias("nothing"),
    )


MEAN_US = "((sum(timestamp) // count(*)) * 1000000 + ((sum(timestamp) % count(*)) * 1000000) // count(*))::BIGINT"


@register(
    "mean_by_key",
    with_(f"SELECT user_id, {r6('avg(duration_seconds)', 'mean_duration')}, {MEAN_US} AS mean_ts_micros FROM raw_interactions GROUP BY 1", RAW),
)
def mean_by_key(spark, sf):
    grouped = X.raw_interactions(spark, sf).groupBy("user_id").agg(
        F.avg("duration_seconds").alias("mean_duration"), F.sum("timestamp").alias("s"), A.rows().alias("n")
    )
    return grouped.select("user_id", "mean_duration", S.mean_timestamp_micros(F.col("s"), F.col("n")).alias("mean_ts_micros"))


@register("count_distinct", with_("SELECT product_id, count(DISTINCT user_id) AS users FROM raw_order_interactions GROUP BY 1", ORDERS))
def count_distinct(spark, sf):
    raw = X.raw_order_interactions(spark, sf)
    return raw.groupBy("product_id").agg(F.count_distinct("user_id").alias("users"))


@register(
    "first_non_null",
    with_(
        f"""SELECT product_id, first(event_type ORDER BY timestamp, event_type) AS event_type,
 {r6('first(duration_seconds ORDER BY timestamp, duration_seconds) FILTER (duration_seconds IS NOT NULL)', 'duration_seconds')}
 FROM raw_interactions WHERE product_id IS NOT NULL GROUP BY 1""",
        RAW,
    ),
)
def first_non_null(spark, sf):
    return A.first_non_null(X.raw_interactions(spark, sf), "product_id", ["event_type", "duration_seconds"], "timestamp")


@register(
    "rule_agg",
    with_(
        f"""SELECT user_id, count(*)::BIGINT AS n, min(timestamp) AS earliest, max(timestamp) AS latest,
 {r6('coalesce(max(duration_seconds) FILTER (timestamp < 1705276800), max(duration_seconds) FILTER (timestamp >= 1705276800))', 'first_duration')},
 {r6('coalesce(max(duration_seconds) FILTER (timestamp >= 1705276800), max(duration_seconds) FILTER (timestamp < 1705276800))', 'last_duration')}
 FROM raw_interactions GROUP BY 1""",
        RAW,
    ),
)
def rule_agg(spark, sf):
    """Two batches per user merged by one rule per column."""
    raw = X.raw_interactions(spark, sf)

    def batch(rows, seq):
        return rows.groupBy("user_id").agg(
            A.rows().alias("n"), F.min("timestamp").alias("earliest"), F.max("timestamp").alias("latest"),
            F.max("duration_seconds").alias("first_duration"), F.max("duration_seconds").alias("last_duration"),
        ).withColumn("seq", F.lit(seq))

    rules = {"n": "sum", "earliest": "min", "latest": "max", "first_duration": "first", "last_duration": "last", "absent": "sum"}
    return A.rule_aggregate(batch(history(raw), 0).unionByName(batch(new_batch(raw), 1)), "user_id", rules, "seq")


@register(
    "conditional_ratio",
    with_(
        f"SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'purchase') AS hits, {r6(O.STRENGTH.replace(O.STRENGTH, 'count(*) FILTER (event_type = ' + chr(39) + 'purchase' + chr(39) + ') / count(*)::DOUBLE'), 'share')} FROM raw_interactions GROUP BY 1",
        RAW,
    ),
)
def conditional_ratio(spark, sf):
    return A.conditional_ratio(X.raw_interactions(spark, sf), "user_id")


CATEGORY_COUNTS = "SELECT user_id, category, count(*) AS n FROM curated GROUP BY ALL"


@register(
    "mode_by_key",
    with_(
        f"SELECT user_id, coalesce(first(category ORDER BY n DESC, category) FILTER (category IS NOT NULL), 'Unknown') AS top_value FROM ({CATEGORY_COUNTS}) GROUP BY 1",
        "curated",
    ),
)
def mode_by_key(spark, sf):
    return A.mode_by_key(stage(spark, sf, "curated"), "user_id", "category")


@register(
    "top_share",
    with_(
        f"SELECT user_id, {r6('coalesce(max(n) FILTER (category IS NOT NULL) / (sum(n) FILTER (category IS NOT NULL))::DOUBLE, 0)', 'top_share')} FROM ({CATEGORY_COUNTS}) GROUP BY 1",
        "curated",
    ),
)
def top_share(spark, sf):
    return A.top_share(stage(spark, sf, "curated"), "user_id", "category")


@register("value_counts", with_("SELECT event_type, count(*) AS n FROM raw_interactions WHERE event_type IS NOT NULL GROUP BY 1", RAW))
def value_counts(spark, sf):
    return A.value_counts(X.raw_interactions(spark, sf), "event_type")


def _first_max(columns: list[str]) -> str:
    best = f"greatest({', '.join(columns)})"
    return "CASE " + " ".join(f"WHEN {c} = {best} THEN '{c[4:]}'" for c in columns) + " END"


_CATS = [f"cat_{c}" for c in O.CATEGORIES]


@register(
    "argmax_onehot",
    with_(
        f"SELECT user_id, {_first_max(_CATS)} AS top_name FROM (SELECT user_id, {', '.join(f'coalesce(sum({c}), 0) AS {c}' for c in _CATS)} FROM curated GROUP BY 1)",
        "curated",
    ),
)
def argmax_onehot(spark, sf):
    df = C.fill_defaults(stage(spark, sf, "curated"), dict.fromkeys(_CATS, 0))
    return A.argmax_one_hot(df, "user_id", _CATS, "cat_")


@register(
    "median",
    with_(f"SELECT 'price' AS name, {r6('median(price)', 'median')} FROM raw_catalog UNION ALL SELECT 'rating_count', {r6('median(rating_count)')} FROM raw_catalog", "raw_catalog"),
)
def median(spark, sf):
    found = M.exact_medians(X.raw_catalog(spark, sf), ["price", "rating_count"])
    return spark.createDataFrame(list(found.items()), "name STRING, median DOUBLE")


@register(
    "corr_matrix",
    with_(
        " UNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, {r6(f'corr({a}, {b})', 'r')} FROM curated"
            for a, b in product(eda.CORRELATED, repeat=2)
        ),
        "curated",
    ),
)
def corr_matrix(spark, sf):
    return A.correlation_pairs(stage(spark, sf, "curated"), eda.CORRELATED)


@register("items_per_user", with_("SELECT user_id, product_id, (SELECT count(DISTINCT t.product_id) FROM train t WHERE t.user_id = train.user_id) AS n_items FROM train GROUP BY 1, 2", "train"))
def items_per_user(spark, sf):
    """The items of a user as rows, with their number; never as one growing array."""
    pairs = content.seen_pairs(split(spark, sf)[0])
    return pairs.join(A.count_by_key(pairs, "user_id").withColumnRenamed("n", "n_items"), "user_id")


@register(
    "weighted_profile",
    with_(
        f"""SELECT i.user_id, {r6('sum(i.implicit_score * p.rating_avg) / sum(i.implicit_score)', 'liked_rating')} FROM interaction_features i
 JOIN product_features p ON i.product_id = p.product_id GROUP BY 1 HAVING sum(i.implicit_score) > 0""",
        "interaction_features", "product_features",
    ),
)
def weighted_profile(spark, sf):
    products = stage(spark, sf, "product_features")
    vectors = products.select("product_id", F.lit("rating_avg").alias("dim"), F.col("rating_avg").alias("value"))
    profile = content.user_profiles(vectors, stage(spark, sf, "interaction_features"))
    return profile.select("user_id", F.col("value").alias("liked_rating"))


@register(
    "duplicate_count",
    with_(
        """SELECT (SELECT count(*) FROM raw_interactions) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_interactions)) AS duplicate_rows,
 (SELECT count(*) FROM raw_interactions) - (SELECT count(*) FROM (SELECT DISTINCT user_id, product_id FROM raw_interactions)) AS duplicate_keys""",
        RAW,
    ),
)
def duplicate_count(spark, sf):
    raw = X.raw_interactions(spark, sf)
    keys = A.duplicate_rows(raw, "user_id", "product_id").scalar()
    return A.duplicate_rows(raw).select(F.col("duplicates").alias("duplicate_rows"), keys.alias("duplicate_keys"))


@register(
    "null_counts",
    with_(
        """SELECT count(*) FILTER (product_id IS NULL) AS null_product_id, count(*) FILTER (duration_seconds IS NULL) AS null_duration_seconds,
 count(*) FILTER (product_id IS NULL OR duration_seconds IS NULL) AS null_any FROM raw_interactions""",
        RAW,
    ),
)
def null_counts(spark, sf):
    return A.null_counts(X.raw_interactions(spark, sf), "product_id", "duration_seconds")


@register(
    "column_stats",
    with_(
        f"""SELECT round(avg(price), 2) + 0.0e0 AS avg_price, {r6('max(price)', 'max_price')}, sum(stock_quantity)::BIGINT AS total_stock,
 (SELECT round(avg(age), 2) + 0.0e0 FROM raw_profiles) AS mean_age FROM raw_catalog""",
        "raw_catalog", "raw_profiles",
    ),
)
def column_stats(spark, sf):
    age = X.raw_profiles(spark, sf).agg(F.bround(F.avg("age"), 2)).scalar()
    stats = X.raw_catalog(spark, sf).agg(
        F.bround(F.avg("price"), 2).alias("avg_price"), F.max("price").alias("max_price"), A.sum_or_zero(F.col("stock_quantity")).alias("total_stock")
    )
    return stats.withColumn("mean_age", age)


@register(
    "regression_metrics",
    with_(
        f"""SELECT {r6('sqrt(avg((y - p) * (y - p)))', 'rmse')}, {r6('avg(abs(y - p))', 'mae')}, {r6('1 - sum((y - p) * (y - p)) / sum((y - m) * (y - m))', 'r2')}
 FROM (SELECT implicit_score AS y, interaction_count * 1.5e0 AS p, avg(implicit_score) OVER () AS m FROM interaction_features)""",
        "interaction_features",
    ),
)
def regression_metrics(spark, sf):
    df = stage(spark, sf, "interaction_features").select("implicit_score", (F.col("interaction_count") * 1.5).alias("p"))
    return A.regression_metrics(df, "implicit_score", "p")


RANKING = f"""SELECT count(*) AS evaluated_users, {r6('avg(hits / 10.0e0)', 'precision_at_n')}, {r6('avg(hits / actual::DOUBLE)', 'recall_at_n')},
 {r6('avg((hits > 0)::INT)', 'hit_rate_at_n')}"""
POPULAR = "SELECT product_id FROM train GROUP BY 1 ORDER BY count(*) DESC, product_id LIMIT 10"


@register(
    "ranking_metrics",
    with_(
        f"""{RANKING} FROM (SELECT user_id, count(*) AS actual, count(*) FILTER (product_id IN ({POPULAR})) AS hits
 FROM (SELECT DISTINCT user_id, product_id FROM test WHERE user_id IN (SELECT user_id FROM train)) GROUP BY 1)""",
        "train", "test",
    ),
)
def ranking_metrics(spark, sf):
    """Metrics of recommending the ten most frequent training items to everybody."""
    train, test = split(spark, sf)
    popular = A.top_counts(train, "product_id", 10).select("product_id")
    pairs = test.select("user_id", "product_id").distinct().join(popular, "product_id", "left_semi")
    return evaluate.ranking_metrics(pairs, test, train.select("user_id").distinct(), 10)


@register(
    "sparsity",
    with_(
        f"""SELECT count(DISTINCT user_id) AS users, count(DISTINCT product_id) AS items, count(*) AS n,
 {r6('1 - count(*) / (count(DISTINCT user_id) * count(DISTINCT product_id))::DOUBLE', 'sparsity')} FROM raw_order_interactions""",
        ORDERS,
    ),
)
def sparsity(spark, sf):
    return A.sparsity(X.raw_order_interactions(spark, sf), "user_id", "product_id")


@register(
    "cold_start",
    with_("SELECT count(*) AS cold_users FROM (SELECT user_id FROM raw_order_interactions GROUP BY 1 HAVING count(*) < 5)", ORDERS),
)
def cold_start(spark, sf):
    return A.cold_start(X.raw_order_interactions(spark, sf), "user_id")


@register(
    "histogram",
    with_(
        """SELECT b.bin, count(c.n) AS n FROM (SELECT unnest(range(50))::BIGINT AS bin) b LEFT JOIN (
 SELECT n, least(floor((n - min(n) OVER ()) / (max(n) OVER () - min(n) OVER ())::DOUBLE * 50.0e0)::BIGINT, 49) AS bin
 FROM (SELECT count(*) AS n FROM raw_order_interactions GROUP BY user_id)) c ON b.bin = c.bin GROUP BY 1""",
        ORDERS,
    ),
)
def histogram(spark, sf):
    return A.histogram(A.count_by_key(X.raw_order_interactions(spark, sf), "user_id"), "n")


@register("dedup_rows", with_(f"{RAW_ROWS} FROM (SELECT DISTINCT * FROM raw_interactions)", RAW))
def dedup_rows(spark, sf):
    return X.raw_interactions(spark, sf).dropDuplicates()


@register(
    "merge_partials",
    with_(
        f"""SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'purchase') AS hits,
 {r6("count(*) FILTER (event_type = 'purchase') / count(*)::DOUBLE", 'share')} FROM raw_interactions GROUP BY 1""",
        RAW,
    ),
)
def merge_partials(spark, sf):
    """Two batches keep only (n, share); purchases are backed out, added, and the share recomputed."""
    raw = X.raw_interactions(spark, sf)
    parts = [A.conditional_ratio(part, "user_id").drop("hits") for part in (history(raw), new_batch(raw))]
    restored = C.union_by_name(*parts).withColumn("hits", F.round(F.col("share") * F.col("n")).cast("bigint"))
    total = restored.groupBy("user_id").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    return total.withColumn("share", S.ratio(F.col("hits"), F.col("n")))


# --- windows --------------------------------------------------------------


@register(
    "lag_seconds",
    with_(
        """SELECT user_id, product_id, timestamp, coalesce(timestamp - lag(timestamp) OVER (PARTITION BY user_id, product_id ORDER BY timestamp), 0) AS gap
 FROM (SELECT user_id, product_id, min(timestamp) AS timestamp FROM raw_interactions WHERE product_id IS NOT NULL GROUP BY user_id, product_id, timestamp // 86400)""",
        RAW,
    ),
)
def lag_seconds(spark, sf):
    """Gaps between the day rows of a pair: a window never holds more rows than there are days."""
    daily = (
        C.drop_null_keys(X.raw_interactions(spark, sf), "product_id")
        .groupBy("user_id", "product_id", F.floor(F.col("timestamp") / 86400).alias("day"))
        .agg(F.min("timestamp").alias("timestamp"))
        .withColumn("us", F.col("timestamp") * 1000000)
    )
    return daily.withColumn("gap", W.lag_seconds(daily, ["user_id", "product_id"], "us")).drop("us", "day")


@register(
    "popularity_score",
    with_(f"SELECT product_id, count(*) AS n, {r6('count(*) / (max(count(*)) OVER ())::DOUBLE', 'popularity')} FROM raw_order_interactions GROUP BY 1", ORDERS),
)
def popularity_score(spark, sf):
    return W.share_of_max(A.count_by_key(X.raw_order_interactions(spark, sf), "product_id"), "n", "popularity")


@register(
    "topn_per_user",
    with_(
        f"""SELECT user_id, product_id, {r6('score', 'score')}, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) AS rank
 FROM (SELECT user_id, product_id, sum(duration_seconds) AS score FROM raw_order_interactions GROUP BY 1, 2) QUALIFY rank <= 5""",
        ORDERS,
    ),
)
def topn_per_user(spark, sf):
    scores = X.raw_order_interactions(spark, sf).groupBy("user_id", "product_id").agg(F.sum("duration_seconds").alias("score"))
    return W.top_n_per_key(scores, "user_id", "score", "product_id", 5)


@register(
    "latest_per_key",
    f"SELECT user_id, event_id, event_type, {r6('value', 'value')} FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
def latest_per_key(spark, sf):
    events = X.table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return W.latest_per_key(events, ["user_id"], ["ts", "event_id"]).drop("ts")


KEEP_LAST = f"""SELECT * FROM (SELECT *, 1 AS seq FROM ({O.interactions_of('curated_new')}) UNION ALL
 SELECT *, 0 AS seq FROM ({O.interactions_of('curated_old')}))
 QUALIFY row_number() OVER (PARTITION BY user_id, product_id, interaction_date ORDER BY seq DESC) = 1"""


@register("keep_last", with_(f"{INTERACTION_ROWS} FROM ({KEEP_LAST})", "curated_old", "curated_new"))
def keep_last(spark, sf):
    old = stage(spark, sf, "interaction_features_old")
    fresh = features.interaction_features(new_batch(stage(spark, sf, "curated")))
    return W.keep_last([old, fresh], ["user_id", "product_id", "interaction_date"])


@register(
    "key_index",
    with_("SELECT product_id, dense_rank() OVER (ORDER BY product_id) - 1 AS position FROM (SELECT DISTINCT product_id FROM raw_order_interactions)", ORDERS),
)
def key_index(spark, sf):
    return W.key_index(X.raw_order_interactions(spark, sf), "product_id")


# --- sorts, limits, sets --------------------------------------------------


@register(
    "sort_rows",
    with_(
        """SELECT user_id, timestamp, product_id, row_number() OVER (ORDER BY user_id, timestamp, product_id) - 1 AS position
 FROM (SELECT DISTINCT user_id, product_id, timestamp FROM raw_interactions WHERE product_id IS NOT NULL)""",
        RAW,
    ),
)
def sort_rows(spark, sf):
    """Rows in (user, time, product) order, the order made visible as a position."""
    rows = C.drop_null_keys(X.raw_interactions(spark, sf), "product_id").select("user_id", "timestamp", "product_id").distinct()
    return W.sorted_positions(rows, "user_id", "timestamp", "product_id")


@register(
    "topk_counts",
    with_(
        """SELECT * FROM (SELECT 'product' AS kind, product_name AS name, count(*) AS n FROM raw_interactions JOIN raw_catalog USING (product_id) GROUP BY 2 ORDER BY n DESC, name LIMIT 10)
 UNION ALL SELECT * FROM (SELECT 'category', category AS name, count(*) AS n FROM raw_catalog GROUP BY 2 ORDER BY n DESC, name LIMIT 5)
 UNION ALL SELECT * FROM (SELECT 'subcategory', subcategory AS name, count(*) AS n FROM raw_catalog GROUP BY 2 ORDER BY n DESC, name LIMIT 5)""",
        RAW, "raw_catalog",
    ),
)
def topk_counts(spark, sf):
    raw, catalog = X.raw_interactions(spark, sf), X.raw_catalog(spark, sf)
    parts = [("product", eda.top_products(raw, catalog, 10)), ("category", A.top_counts(catalog, "category", 5)), ("subcategory", A.top_counts(catalog, "subcategory", 5))]
    named = [df.select(F.lit(kind).alias("kind"), F.col(df.columns[0]).alias("name"), "n") for kind, df in parts]
    return C.union_by_name(*named)


@register("best_run", with_(f"SELECT run_id, {r6('c_hr', 'best_value')} FROM raw_runs WHERE c_hr > 0 ORDER BY c_hr DESC, start_time DESC, run_id DESC LIMIT 1", "raw_runs"))
def best_run(spark, sf):
    return runs.best_run(X.raw_runs(spark, sf)).select("run_id", "best_value")


@register(
    "latest_run",
    with_(f"SELECT run_id, {when('start_time', 'started')} FROM raw_runs WHERE status = 'FINISHED' ORDER BY start_time DESC, run_id DESC LIMIT 1", "raw_runs"),
)
def latest_run(spark, sf):
    return runs.latest_run(X.raw_runs(spark, sf)).select("run_id", F.col("start_time").alias("started"))


def _text(c: str, name: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN 'N/A' ELSE printf('%.4f', {c}) END AS {name}"


@register(
    "recent_runs",
    with_(
        f"""SELECT run_id, status, coalesce(model_type, 'Unknown') AS model_type, {_text('s_hr', 'svd_hit_rate')}, {_text('c_hr', 'cb_hit_rate')},
 {_text('s_pr', 'svd_precision')}, {_text('c_pr', 'cb_precision')}, {when('start_time', 'start_time')} FROM raw_runs ORDER BY raw_runs.start_time DESC, run_id DESC LIMIT 5""",
        "raw_runs",
    ),
)
def recent_runs(spark, sf):
    return runs.recent_runs(X.raw_runs(spark, sf), 5)


@register("sample_users", with_("SELECT DISTINCT user_id FROM raw_order_interactions ORDER BY 1 LIMIT 20", ORDERS))
def sample_users(spark, sf):
    return evaluate.sample_users(X.raw_order_interactions(spark, sf), 20)


@register(
    "union_by_name",
    with_(
        f"""SELECT user_id, product_id, event_type, timestamp, {r6('duration_seconds', 'duration_seconds')}, NULL::VARCHAR AS channel FROM raw_interactions
 UNION ALL SELECT user_id, product_id, event_type, timestamp, NULL::DOUBLE, 'order' FROM raw_order_interactions""",
        RAW, ORDERS,
    ),
)
def union_by_name(spark, sf):
    orders = X.raw_order_interactions(spark, sf).drop("duration_seconds").withColumn("channel", F.lit("order"))
    return C.union_by_name(X.raw_interactions(spark, sf), orders)


@register("union_distinct", with_("SELECT user_id, product_id FROM raw_interactions UNION SELECT user_id, product_id FROM raw_order_interactions", RAW, ORDERS))
def union_distinct(spark, sf):
    pair = ["user_id", "product_id"]
    return X.raw_interactions(spark, sf).select(*pair).union(X.raw_order_interactions(spark, sf).select(*pair)).distinct()


@register(
    "set_intersect",
    with_("SELECT DISTINCT user_id, product_id FROM train SEMI JOIN test USING (user_id, product_id)", "train", "test"),
)
def set_intersect(spark, sf):
    """Pairs in both parts of the split, by semi-join on distinct rows."""
    train, test = split(spark, sf)
    return J.semi_join(content.seen_pairs(train), content.seen_pairs(test), "user_id", "product_id")


