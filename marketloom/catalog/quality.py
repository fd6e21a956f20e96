"""Data-quality checks, suites, failures, report and gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom import fixtures as X
from marketloom.catalog.base import register
from marketloom.catalog.oracle import when, with_
from marketloom.catalog.scans_sinks import all_reports
from marketloom.operators import quality as Q
from marketloom.session import scratch_path

VALID = "event_type IN ('view', 'click', 'add_to_cart', 'purchase')"


def checks_sql(dataset: str, rows: list[tuple[str, str, str]]) -> str:
    """(rule, column, unexpected-count expression) to the result rows of a suite."""
    return " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, '{rule}' AS rule, '{column}' AS \"column\", ({n})::BIGINT AS unexpected, (({n}) = 0)::BIGINT AS success"
        for rule, column, n in rows
    )


def bad(table: str, condition: str) -> str:
    return f"SELECT count(*) FILTER ({condition}) FROM {table}"


def repeated(table: str, column: str) -> str:
    return f"SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {table} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"


RAW, PROFILES, CATALOG = "raw_interactions", "raw_profiles", "raw_catalog"
INTERACTION_CHECKS = [
    *[(Q.NOT_NULL, c, bad(RAW, f"{c} IS NULL")) for c in ("user_id", "product_id", "timestamp")],
    (Q.IN_SET, "event_type", bad(RAW, f"NOT {VALID}")),
    (Q.BETWEEN, "duration_seconds", bad(RAW, "duration_seconds < 0")),
    *[(Q.OF_TYPE, c, "SELECT 0") for c in ("user_id", "product_id", "timestamp")],
    (Q.OF_TYPE, "duration_seconds", "SELECT 1"),  # the generated durations are doubles
]
NOT_LETTERS = "NOT regexp_full_match({c}, '[A-Za-z]+')"
PROFILE_CHECKS = [
    (Q.UNIQUE, "user_id", repeated(PROFILES, "user_id")),
    (Q.IN_SET, "tier", bad(PROFILES, "tier NOT IN ('basic', 'premium')")),
    *[(Q.NOT_NULL, c, bad(PROFILES, f"{c} IS NULL")) for c in ("location_city", "location_country", "age")],
    (Q.BETWEEN, "age", bad(PROFILES, "age < 18 OR age > 120")),
    *[(Q.REGEX, c, bad(PROFILES, NOT_LETTERS.format(c=c))) for c in ("location_country", "location_city")],
    *[(Q.OF_TYPE, c, "SELECT 0") for c in ("user_id", "age", "tier", "location_country", "location_city")],
]
CATALOG_CHECKS = [
    (Q.UNIQUE, "product_id", repeated(CATALOG, "product_id")),
    (Q.BETWEEN, "rating_avg", bad(CATALOG, "rating_avg < 1 OR rating_avg > 5")),
    (Q.BETWEEN, "price", bad(CATALOG, "price < 0.01e0")),
    (Q.BETWEEN, "stock_quantity", bad(CATALOG, "stock_quantity < 0")),
    *[(Q.NOT_NULL, c, bad(CATALOG, f"{c} IS NULL")) for c in ("category_id", "subcategory_id", "product_id")],
    *[(Q.OF_TYPE, c, "SELECT 0") for c in ("product_id", "category_id", "subcategory_id", "rating_avg", "price", "stock_quantity")],
]


def metrics_sql(dataset: str, table: str, metrics: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, '{m}' AS metric, ({e})::VARCHAR AS value FROM {table}" for m, e in metrics.items()
    )


def spread_sql(dataset: str, table: str, column: str, metric: str) -> str:
    return f"SELECT '{dataset}' AS dataset, '{metric}.' || {column} AS metric, count(*)::VARCHAR AS value FROM {table} WHERE {column} IS NOT NULL GROUP BY {column}"


def totals_sql(dataset: str, checks: str) -> str:
    return f"""SELECT '{dataset}' AS dataset, 'expectations_passed' AS metric, count(*) FILTER (success = 1)::VARCHAR AS value FROM ({checks})
 UNION ALL SELECT '{dataset}', 'expectations_failed', count(*) FILTER (success = 0)::VARCHAR FROM ({checks})"""


def n(condition: str) -> str:
    return f"count(*) FILTER ({condition})"


def outside(expected: str) -> str:
    return n(f"NOT coalesce({expected}, false)")


SUITE_SQL = {
    "user_interactions": " UNION ALL ".join(
        [
            metrics_sql(
                "user_interactions", RAW,
                {
                    "total_records": "count(*)",
                    "stats_date_min": when("make_timestamp(min(timestamp) * 1000000)"),
                    "stats_date_max": when("make_timestamp(max(timestamp) * 1000000)"),
                    "missing_user_ids": n("user_id IS NULL"),
                    "invalid_events": outside(VALID),
                    "invalid_duration_seconds": outside("duration_seconds BETWEEN 0 AND 3600"),
                    "invalid_user_ids": outside("user_id BETWEEN 0 AND 2147483647"),
                    "invalid_product_ids": outside("product_id BETWEEN 0 AND 2147483647"),
                    "invalid_timestamps": outside("timestamp >= 0"),
                    "stats_unique_users": "count(DISTINCT user_id)",
                    "stats_unique_products": "count(DISTINCT product_id)",
                    "duplicates": "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_interactions))",
                },
            ),
            spread_sql("user_interactions", RAW, "event_type", "stats_event_distribution"),
            totals_sql("user_interactions", checks_sql("user_interactions", INTERACTION_CHECKS)),
        ]
    ),
    "user_profiles": " UNION ALL ".join(
        [
            metrics_sql(
                "user_profiles", PROFILES,
                {
                    "total_records": "count(*)",
                    "stats_age_mean": "round(avg(age), 2)",
                    "missing_location": n("location_city IS NULL OR location_country IS NULL"),
                    "invalid_tier": outside("tier IN ('basic', 'premium')"),
                    "invalid_age": outside("age BETWEEN 18 AND 120"),
                    "invalid_country_type": n(NOT_LETTERS.format(c="trim(location_country)")),
                    "invalid_city_type": n(NOT_LETTERS.format(c="trim(location_city)")),
                    "stats_unique_cities": "count(DISTINCT location_city)",
                    "stats_unique_countries": "count(DISTINCT location_country)",
                    "duplicate_users": "count(*) - count(DISTINCT user_id)",
                },
            ),
            spread_sql("user_profiles", PROFILES, "tier", "stats_tier_counts"),
            totals_sql("user_profiles", checks_sql("user_profiles", PROFILE_CHECKS)),
        ]
    ),
    "product_catalog": " UNION ALL ".join(
        [
            metrics_sql(
                "product_catalog", CATALOG,
                {
                    "total_records": "count(*)",
                    "stats_avg_price": "round(avg(price), 2)",
                    "stats_max_price": "max(price)",
                    "stats_total_stock": "sum(stock_quantity)",
                    "invalid_ratings": n("rating_avg < 1 OR rating_avg > 5"),
                    "missing_category_ids": n("category_id IS NULL"),
                    "missing_subcategory_ids": n("subcategory_id IS NULL"),
                    "invalid_prices": n("price <= 0"),
                    "invalid_category_ids": n("category_id < 0"),
                    "invalid_subcategory_ids": n("subcategory_id < 0"),
                    "invalid_product_ids": n("product_id < 0"),
                    "invalid_stock_quantity": n("stock_quantity < 0"),
                },
            ),
            spread_sql("product_catalog", CATALOG, "category", "stats_category_counts"),
            totals_sql("product_catalog", checks_sql("product_catalog", CATALOG_CHECKS)),
        ]
    ),
}
TABLES = {"user_interactions": RAW, "user_profiles": PROFILES, "product_catalog": CATALOG}
LOADERS = {"user_interactions": X.raw_interactions, "user_profiles": X.raw_profiles, "product_catalog": X.raw_catalog}
ALL_CHECKS = " UNION ALL ".join(
    checks_sql(d, c)
    for d, c in (("user_interactions", INTERACTION_CHECKS), ("user_profiles", PROFILE_CHECKS), ("product_catalog", CATALOG_CHECKS))
)


def one_rule(name: str, rule: str) -> None:
    """Register one rule over all suites that use it."""

    def build(spark, sf):
        parts = [
            Q.run_checks(LOADERS[d](spark, sf), d, [c for c in suite if c.rule == rule])
            for d, (suite, _) in Q.SUITES.items()
            if any(c.rule == rule for c in suite)
        ]
        result = parts[0]
        for part in parts[1:]:
            result = result.unionByName(part)
        return result

    register(name, with_(f"SELECT * FROM ({ALL_CHECKS}) WHERE rule = '{rule}'", RAW, PROFILES, CATALOG))(build)


for _name, _rule in (
    ("dq_not_null", Q.NOT_NULL),
    ("dq_in_set", Q.IN_SET),
    ("dq_between", Q.BETWEEN),
    ("dq_type", Q.OF_TYPE),
    ("dq_unique", Q.UNIQUE),
    ("dq_regex", Q.REGEX),
):
    one_rule(_name, _rule)


def one_suite(name: str, dataset: str) -> None:
    def build(spark, sf):
        return Q.suite_report(LOADERS[dataset](spark, sf), dataset)

    register(name, with_(SUITE_SQL[dataset], TABLES[dataset]))(build)


for _name, _dataset in (("dq_interactions", "user_interactions"), ("dq_profiles", "user_profiles"), ("dq_catalog", "product_catalog")):
    one_suite(_name, _dataset)


def all_checks(spark, sf):
    result = None
    for dataset, load in LOADERS.items():
        part = Q.validate(load(spark, sf), dataset)
        result = part if result is None else result.unionByName(part)
    return result


@register(
    "dq_failures",
    with_(
        f"""SELECT dataset, rule, "column", unexpected, rule || ' failed on ' || "column" ||
 CASE WHEN dataset = 'user_profiles' THEN ': ' || unexpected || ' failures' ELSE '' END AS message FROM ({ALL_CHECKS}) WHERE success = 0""",
        RAW, PROFILES, CATALOG,
    ),
)
def dq_failures(spark, sf):
    return Q.failures(all_checks(spark, sf))


@register(
    "dq_gate",
    with_(f"""SELECT dataset, rule, "column" FROM ({ALL_CHECKS}) WHERE success = 0""", RAW, PROFILES, CATALOG),
)
def dq_gate(spark, sf):
    """The checks on whose account the gate stops the raw data, as the error tells them."""
    raw = {"user_interactions": X.raw_interactions(spark, sf), "user_profiles": X.raw_profiles(spark, sf), "product_catalog": X.raw_catalog(spark, sf)}
    try:
        Q.gate(raw)
        failed = []
    except Q.QualityGateError as error:
        failed = error.failed
    return spark.createDataFrame(failed, "dataset STRING, rule STRING, `column` STRING")


@register(
    "quality_report",
    with_(
        """SELECT dataset, list_aggregate(list_transform(string_split(metric, '_'), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ') || ': ' || value AS line
 FROM ("""
        + " UNION ALL ".join(SUITE_SQL.values())
        + ")",
        RAW, PROFILES, CATALOG,
    ),
)
def quality_report(spark, sf):
    path = scratch_path(spark, "report")
    Q.labelled(all_reports(spark, sf)).write.partitionBy("dataset").text(path)
    return spark.read.text(path).select("dataset", F.col("value").alias("line"))
