"""Recommender jobs: split, SVD, content vectors, top-N and their metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.catalog.base import register
from marketloom.catalog.oracle import r6, with_
from marketloom.catalog.relational import HITS, RANKING
from marketloom.catalog.stages import split, stage
from marketloom.plans import content, evaluate, svd

_models: dict[tuple[str, str, str, int], svd.SvdModel] = {}
# two components, so that SQL can find the same ones by power iteration
SHOWN = 2


def model(spark, sf, method="tiled", components=SHOWN):
    """The SVD fitted on the training part, once per session and folder; that of few components to what SQL can compare."""
    key = (spark.sparkContext.applicationId, sf, method, components)
    if key not in _models:
        exact = {"steps": 40, "tolerance": 1e-11, "oversample": 30} if components == SHOWN else {}
        # more columns than needed make the plain steps of the joined way few
        options = {"oversample": 40} if method == "joined" else exact
        _models[key] = svd.fit(split(spark, sf)[0], components, method=method, **options)
    return _models[key]


PAIR = "user_id, product_id, strftime(interaction_date, '%Y-%m-%d') AS interaction_date"


@register(
    "train_test_split",
    with_(f"SELECT {PAIR}, 'train' AS part FROM train UNION ALL SELECT {PAIR}, 'test' FROM test", "train", "test"),
)
def train_test_split(spark, sf):
    train, test = split(spark, sf)
    keys = ["user_id", "product_id", "interaction_date"]
    return train.select(*keys, F.lit("train").alias("part")).unionByName(test.select(*keys, F.lit("test").alias("part")))


@register("interaction_matrix", with_(f"SELECT user_id, product_id, {r6('sum(implicit_score)', 'score')} FROM train GROUP BY 1, 2", "train"))
def interaction_matrix(spark, sf):
    return svd.interaction_matrix(split(spark, sf)[0])


SINGULAR = with_(
    f"SELECT 0::BIGINT AS component, {r6('s1', 'singular_value')}, 1.0e0 AS length FROM svd_first UNION ALL SELECT 1, {r6('s2', 'singular_value')}, 1.0e0 FROM svd_second",
    "svd_second",
)


def shown(spark, fitted):
    """Singular values and the item factors' squared length along each component (always 1)."""
    values = spark.createDataFrame(list(enumerate(fitted.singular_values)), "component INT, singular_value DOUBLE")
    spread = fitted.item_factors.select(F.posexplode("factors").alias("component", "x"))
    return values.join(spread.groupBy("component").agg(F.sum(F.col("x") * F.col("x")).alias("length")), "component")


@register("svd_fit", SINGULAR)
def svd_fit(spark, sf):
    return shown(spark, model(spark, sf))


@register("svd_fit_joined", SINGULAR)
def svd_fit_joined(spark, sf):
    """The same with the basis as a table."""
    return shown(spark, model(spark, sf, "joined"))


@register("svd_rank50")
def svd_rank50(spark, sf):
    """The model as it is trained: 50 components in a bounded number of steps, with the residual that they leave."""
    fitted = model(spark, sf, components=svd.COMPONENTS)
    return shown(spark, fitted).withColumn("converged", F.lit(int(fitted.residual < 0.05)))


@register(
    "svd_explained_variance",
    with_(
        f"""SELECT {r6('kept / total', 'explained_variance')} FROM (SELECT var_pop(x) + var_pop(y) AS kept, count(*)::DOUBLE AS n FROM svd_u),
 (SELECT sum(s2 / m - (s / m) * (s / m)) AS total FROM (SELECT sum(score) AS s, sum(score * score) AS s2 FROM svd_m GROUP BY product_id), (SELECT count(DISTINCT user_id)::DOUBLE AS m FROM svd_m))""",
        "svd_u",
    ),
)
def svd_explained_variance(spark, sf):
    return svd.explained_variance(model(spark, sf))


@register("svd_predict", with_(f"SELECT user_id, product_id, implicit_score, {r6('prediction', 'prediction')} FROM svd_predicted", "svd_predicted"))
def svd_predict(spark, sf):
    return svd.predict(model(spark, sf), split(spark, sf)[1].select("user_id", "product_id", "implicit_score"))


@register(
    "predict_lookup",
    with_(
        f"""SELECT k.user_id, k.product_id, {r6('coalesce(u.purchase_ratio * p.conversion_rate + u.category_confidence * p.diversity_score, 0)', 'prediction')}
 FROM (SELECT DISTINCT user_id, product_id FROM test UNION ALL SELECT DISTINCT user_id, -1 - product_id FROM test) k
 LEFT JOIN user_features u ON k.user_id = u.user_id LEFT JOIN product_features p ON k.product_id = p.product_id""",
        "test", "user_features", "product_features",
    ),
)
def predict_lookup(spark, sf):
    """Two-entry factors taken from the feature tables; every test pair, and the same user with an unknown item (score 0)."""
    users, products = stage(spark, sf, "user_features"), stage(spark, sf, "product_features")
    factors = svd.SvdModel(
        None,
        users.select("user_id", F.array("purchase_ratio", "category_confidence").alias("factors")),
        products.select("product_id", F.array("conversion_rate", "diversity_score").alias("factors")),
        [],
    )
    pairs = content.seen_pairs(split(spark, sf)[1])
    unknown = pairs.withColumn("product_id", -1 - F.col("product_id"))
    return svd.predict(factors, pairs.unionByName(unknown))


@register("svd_recommend", with_(f"SELECT user_id, product_id, {r6('score', 'score')}, rank FROM svd_recs", "svd_recs"))
def svd_recommend(spark, sf):
    return svd.recommend(model(spark, sf), 10)


@register(
    "svd_evaluate",
    with_(
        f"""SELECT r.*, e.* FROM ({RANKING} FROM (SELECT t.user_id, count(*) AS actual, count(r.product_id) AS hits
 FROM (SELECT DISTINCT user_id, product_id FROM test WHERE user_id IN (SELECT user_id FROM svd_u)) t
 LEFT JOIN svd_recs r ON t.user_id = r.user_id AND t.product_id = r.product_id GROUP BY 1)) r,
 (SELECT {r6('sqrt(avg((a - prediction) * (a - prediction)))', 'rmse')}, {r6('avg(abs(a - prediction))', 'mae')},
 {r6('1 - sum((a - prediction) * (a - prediction)) / (var_pop(a) * count(a))', 'r2')} FROM (SELECT *, implicit_score::DOUBLE AS a FROM svd_predicted)) e""",
        "svd_recs", "svd_predicted",
    ),
)
def svd_evaluate(spark, sf):
    fitted, test = model(spark, sf), split(spark, sf)[1]
    ranking = evaluate.ranking_metrics(svd.recommend(fitted, 10), test, fitted.user_factors.select("user_id"), 10)
    errors = svd.prediction_error(fitted, test)
    return ranking.withColumn("k", F.lit(1)).join(errors.withColumn("k", F.lit(1)), "k").drop("k")


@register("item_vectors", with_(f"SELECT product_id, dim, {r6('value', 'value')} FROM item_vectors", "item_vectors"))
def item_vectors(spark, sf):
    return content.item_vectors(stage(spark, sf, "product_features"))


@register("user_profiles_cb", with_(f"SELECT user_id, dim, {r6('value', 'value')} FROM user_profiles_cb", "user_profiles_cb"))
def user_profiles_cb(spark, sf):
    return content.user_profiles(stage(spark, sf, "item_vectors"), split(spark, sf)[0])


@register("content_recommend", with_(f"SELECT user_id, product_id, {r6('score', 'score')}, rank FROM content_recs", "content_recs"))
def content_recommend(spark, sf):
    return content.recommend(stage(spark, sf, "item_vectors"), stage(spark, sf, "user_profiles_cb"), split(spark, sf)[0], 10)


@register("content_evaluate", with_(f"{RANKING} FROM ({HITS})", "test", "content_recs", "user_profiles_cb"))
def content_evaluate(spark, sf):
    known = content.known_users(stage(spark, sf, "user_profiles_cb"))
    return evaluate.ranking_metrics(stage(spark, sf, "content_recs"), split(spark, sf)[1], known, 10)


@register(
    "avg_confidence",
    with_(
        f"""SELECT {r6('coalesce(avg(s), 0)', 'avg_confidence')} FROM (SELECT avg(score) AS s FROM content_recs
 WHERE user_id IN (SELECT DISTINCT user_id FROM train ORDER BY 1 LIMIT 5) GROUP BY user_id)""",
        "content_recs", "train",
    ),
)
def avg_confidence(spark, sf):
    return content.average_confidence(stage(spark, sf, "content_recs"), evaluate.sample_users(split(spark, sf)[0], 5))
