"""Declarative data-quality checks, suites and the gate.

A suite is a list of checks. All row-level checks and statistics of a suite are
one aggregate over one scan; only uniqueness and duplicates group the rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions import scalars as S
from marketloom.operators import aggregates as A
from marketloom.operators.cleaning import tolerant_ids
from marketloom.schemas import EVENT_TYPES, TIERS

# fixed values: rule names
NOT_NULL = "expect_column_values_to_not_be_null"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
OF_TYPE = "expect_column_values_to_be_of_type"
UNIQUE = "expect_column_values_to_be_unique"
REGEX = "expect_column_values_to_match_regex"
INT32_MAX = 2**31 - 1
MAX_DURATION = 3600
EPOCH_FLOOR = 0


@dataclass(frozen=True)
class Check:
    rule: str
    column: str
    allowed: tuple = ()
    low: float | None = None
    high: float | None = None
    pattern: str = ""
    dtype: T.DataType | None = None

    def violation(self) -> Column:
        """True for an unexpected value. Nulls are only unexpected for the not-null rule."""
        c = F.col(self.column)
        if self.rule == NOT_NULL:
            return c.isNull()
        if self.rule == IN_SET:
            return ~c.isin(*self.allowed)
        if self.rule == REGEX:
            return ~c.rlike(self.pattern)
        low = F.lit(False) if self.low is None else c < F.lit(self.low)
        high = F.lit(False) if self.high is None else c > F.lit(self.high)
        return low | high


def not_null(column: str) -> Check:
    return Check(NOT_NULL, column)


def in_set(column: str, allowed: Iterable) -> Check:
    return Check(IN_SET, column, allowed=tuple(allowed))


def between(column: str, low=None, high=None) -> Check:
    return Check(BETWEEN, column, low=low, high=high)


def of_type(column: str, dtype: T.DataType) -> Check:
    return Check(OF_TYPE, column, dtype=dtype)


def unique(column: str) -> Check:
    return Check(UNIQUE, column)


def matches(column: str, pattern: str) -> Check:
    return Check(REGEX, column, pattern=pattern)


LONG, DOUBLE, STRING = T.LongType(), T.DoubleType(), T.StringType()
INTERACTION_SUITE = [
    *[not_null(c) for c in ("user_id", "product_id", "timestamp")],
    in_set("event_type", EVENT_TYPES),
    between("duration_seconds", low=0),
    *[of_type(c, LONG) for c in ("user_id", "product_id", "timestamp", "duration_seconds")],
]
PROFILE_SUITE = [
    unique("user_id"),
    in_set("tier", TIERS),
    *[not_null(c) for c in ("location_city", "location_country", "age")],
    between("age", low=18, high=120),
    *[matches(c, S.LETTERS_ONLY) for c in ("location_country", "location_city")],
    *[of_type(c, LONG) for c in ("user_id", "age")],
    *[of_type(c, STRING) for c in ("tier", "location_country", "location_city")],
]
CATALOG_SUITE = [
    unique("product_id"),
    between("rating_avg", low=1.0, high=5.0),
    between("price", low=0.01),
    between("stock_quantity", low=0),
    *[not_null(c) for c in ("category_id", "subcategory_id", "product_id")],
    *[of_type(c, LONG) for c in ("product_id", "category_id", "subcategory_id")],
    *[of_type(c, DOUBLE) for c in ("rating_avg", "price")],
    of_type("stock_quantity", LONG),
]
COERCED = ["user_id", "product_id", "category_id", "subcategory_id", "age", "duration_seconds", "timestamp", "stock_quantity"]


def coerce(df: DataFrame) -> DataFrame:
    """Integer columns with unreadable or null values as 0: the lenient mode of the suites."""
    return tolerant_ids(df, *COERCED)


def _repeated(df: DataFrame, column: str) -> DataFrame:
    """Rows of repeated values: every one of them is unexpected, not only the extras."""
    return A.count_by_key(df, column).agg(
        A.sum_or_zero(F.when(F.col("n") > 1, F.col("n"))).alias("unexpected")
    )


def run_checks(df: DataFrame, dataset: str, checks: list[Check]) -> DataFrame:
    """One (dataset, rule, column, unexpected, success) row per check."""
    spark = df.sparkSession
    typed = [c for c in checks if c.rule == OF_TYPE]
    grouped = [c for c in checks if c.rule == UNIQUE]
    by_row = [c for c in checks if c not in typed and c not in grouped]
    parts = []
    if by_row:
        counts = df.agg(*[F.count_if(c.violation()).alias(f"n_{i}") for i, c in enumerate(by_row)])
        cells = [
            F.struct(F.lit(c.rule).alias("rule"), F.lit(c.column).alias("column"), F.col(f"n_{i}").alias("unexpected"))
            for i, c in enumerate(by_row)
        ]
        parts.append(counts.select(F.inline(F.array(*cells))))
    for c in grouped:
        parts.append(_repeated(df, c.column).select(F.lit(c.rule).alias("rule"), F.lit(c.column).alias("column"), "unexpected"))
    if typed:
        wrong = [(c.rule, c.column, int(df.schema[c.column].dataType != c.dtype)) for c in typed]
        parts.append(spark.createDataFrame(wrong, "rule STRING, column STRING, unexpected BIGINT"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.select(
        F.lit(dataset).alias("dataset"),
        "rule",
        "column",
        F.col("unexpected").cast("bigint").alias("unexpected"),
        (F.col("unexpected") == 0).alias("success"),
    )


def _invalid(expected: Column) -> Column:
    """Count of rows that fail or cannot be judged because of a null."""
    return F.count_if(~F.coalesce(expected, F.lit(False)))


def _moment(c: Column) -> Column:
    return F.coalesce(F.date_format(S.epoch_to_ts(c), "yyyy-MM-dd HH:mm:ss"), F.lit("N/A"))


def _unpivot(stats: DataFrame) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value")) for c in stats.columns]
    return stats.select(F.inline(F.array(*cells)))


def _distribution(df: DataFrame, column: str, metric: str) -> DataFrame:
    return A.value_counts(df, column).select(
        F.concat(F.lit(f"{metric}."), F.col(column)).alias("metric"), F.col("n").cast("string").alias("value")
    )


@dataclass(frozen=True)
class Profile:
    """Statistics of a dataset: those of one aggregate over its rows, and those that group them."""

    stats: list[Column]
    grouped: list[DataFrame]


def profile_interactions(df: DataFrame) -> Profile:
    c = F.col
    return Profile(
        [
            A.rows().alias("total_records"),
            _moment(F.min("timestamp")).alias("stats_date_min"),
            _moment(F.max("timestamp")).alias("stats_date_max"),
            F.count_if(c("user_id").isNull()).alias("missing_user_ids"),
            _invalid(c("event_type").isin(*EVENT_TYPES)).alias("invalid_events"),
            _invalid(c("duration_seconds").between(0, MAX_DURATION)).alias("invalid_duration_seconds"),
            _invalid(c("user_id").between(0, INT32_MAX)).alias("invalid_user_ids"),
            _invalid(c("product_id").between(0, INT32_MAX)).alias("invalid_product_ids"),
            _invalid(c("timestamp") >= EPOCH_FLOOR).alias("invalid_timestamps"),
        ],
        [
            _unpivot(df.agg(F.count_distinct("user_id").alias("stats_unique_users"))),
            _unpivot(df.agg(F.count_distinct("product_id").alias("stats_unique_products"))),
            _unpivot(A.duplicate_rows(df)),
            _distribution(df, "event_type", "stats_event_distribution"),
        ],
    )


def profile_profiles(df: DataFrame) -> Profile:
    c = F.col
    return Profile(
        [
            A.rows().alias("total_records"),
            F.bround(F.avg("age"), 2).alias("stats_age_mean"),
            F.count_if(c("location_city").isNull() | c("location_country").isNull()).alias("missing_location"),
            _invalid(c("tier").isin(*TIERS)).alias("invalid_tier"),
            _invalid(c("age").between(18, 120)).alias("invalid_age"),
            F.count_if(S.not_letters(c("location_country"))).alias("invalid_country_type"),
            F.count_if(S.not_letters(c("location_city"))).alias("invalid_city_type"),
        ],
        [
            _unpivot(df.agg(F.count_distinct("location_city").alias("stats_unique_cities"))),
            _unpivot(df.agg(F.count_distinct("location_country").alias("stats_unique_countries"))),
            _unpivot(A.duplicate_rows(df, "user_id").withColumnRenamed("duplicates", "duplicate_users")),
            _distribution(df, "tier", "stats_tier_counts"),
        ],
    )


def profile_catalog(df: DataFrame) -> Profile:
    c = F.col
    return Profile(
        [
            A.rows().alias("total_records"),
            F.bround(F.avg("price"), 2).alias("stats_avg_price"),
            F.max("price").alias("stats_max_price"),
            A.sum_or_zero(c("stock_quantity")).alias("stats_total_stock"),
            F.count_if((c("rating_avg") < 1) | (c("rating_avg") > 5)).alias("invalid_ratings"),
            F.count_if(c("category_id").isNull()).alias("missing_category_ids"),
            F.count_if(c("subcategory_id").isNull()).alias("missing_subcategory_ids"),
            F.count_if(c("price") <= 0).alias("invalid_prices"),
            F.count_if(c("category_id") < 0).alias("invalid_category_ids"),
            F.count_if(c("subcategory_id") < 0).alias("invalid_subcategory_ids"),
            F.count_if(c("product_id") < 0).alias("invalid_product_ids"),
            F.count_if(c("stock_quantity") < 0).alias("invalid_stock_quantity"),
        ],
        [_distribution(df, "category", "stats_category_counts")],
    )


SUITES = {
    "user_interactions": (INTERACTION_SUITE, profile_interactions),
    "user_profiles": (PROFILE_SUITE, profile_profiles),
    "product_catalog": (CATALOG_SUITE, profile_catalog),
}


def validate(df: DataFrame, dataset: str, coerce_first: bool = False) -> DataFrame:
    """Check results of a dataset by its suite."""
    frame = coerce(df) if coerce_first else df
    return run_checks(frame, dataset, _usable(frame, dataset))


def _usable(df: DataFrame, dataset: str) -> list[Check]:
    return [c for c in SUITES[dataset][0] if c.column in df.columns]


def suite_report(df: DataFrame, dataset: str, coerce_first: bool = False) -> DataFrame:
    """Profile metrics plus passed and failed totals as (dataset, metric, value) rows.

    Statistics and row-level checks share one aggregate over one scan.
    """
    frame = coerce(df) if coerce_first else df
    checks, profile = _usable(frame, dataset), SUITES[dataset][1](frame)
    typed = sum(frame.schema[c.column].dataType == c.dtype for c in checks if c.rule == OF_TYPE)
    by_row = [c for c in checks if c.rule not in (OF_TYPE, UNIQUE)]
    repeated = [_repeated(frame, c.column).scalar() for c in checks if c.rule == UNIQUE]
    counted = [F.count_if(c.violation()).alias(f"_n_{i}") for i, c in enumerate(by_row)]
    row = frame.agg(*profile.stats, *counted)
    passed = F.lit(typed)
    for count in [*(F.col(f"_n_{i}") for i in range(len(by_row))), *repeated]:
        passed = passed + (count == 0).cast("bigint")
    row = row.withColumns({"expectations_passed": passed, "expectations_failed": F.lit(len(checks)) - passed})
    report = _unpivot(row.drop(*[f"_n_{i}" for i in range(len(by_row))]))
    for part in profile.grouped:
        report = report.unionByName(part)
    return report.select(F.lit(dataset).alias("dataset"), "metric", "value")


def failures(results: DataFrame, with_counts: Iterable[str] = ("user_profiles",)) -> DataFrame:
    """Readable lines for failed checks; the datasets in ``with_counts`` also say how many rows failed."""
    line = F.concat(F.col("rule"), F.lit(" failed on "), F.col("column"))
    counted = F.concat(line, F.lit(": "), F.col("unexpected").cast("string"), F.lit(" failures"))
    return results.where(~F.col("success")).select(
        "dataset", "rule", "column", "unexpected",
        F.when(F.col("dataset").isin(*with_counts), counted).otherwise(line).alias("message"),
    )


def labelled(report: DataFrame) -> DataFrame:
    """One text line per metric, its key as a title."""
    return report.select(
        "dataset", F.concat(S.metric_label(F.col("metric")), F.lit(": "), F.coalesce("value", F.lit("None"))).alias("line")
    )


class QualityGateError(RuntimeError):
    """A dataset was empty or failed its suite; ``failed`` has (dataset, rule, column) of every failed check."""

    def __init__(self, message: str, failed: list[tuple[str, str, str]] = ()):
        super().__init__(message)
        self.failed = list(failed)


def gate(datasets: dict[str, DataFrame], coerce_first: bool = False) -> DataFrame:
    """Run every suite and raise if a dataset is empty or any check fails; else the results.

    Only one row per dataset and failed check reaches the driver.
    """
    empty = [name for name, df in datasets.items() if df.isEmpty()]
    results = None
    for name, df in datasets.items():
        part = validate(df, name, coerce_first)
        results = part if results is None else results.unionByName(part)
    failed = failures(results).orderBy("dataset", "rule", "column").collect()
    if empty or failed:
        told = [f"{n} is empty" for n in empty] + [r["message"] for r in failed]
        raise QualityGateError("; ".join(told), [(r["dataset"], r["rule"], r["column"]) for r in failed])
    return results
