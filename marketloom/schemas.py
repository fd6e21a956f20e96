"""Table schemas, default values and feature views."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values ---------------------------------------------------------
EVENT_STRENGTH = {"view": 1, "click": 2, "add_to_cart": 3, "purchase": 4}
EVENT_TYPES = list(EVENT_STRENGTH)
TIERS = ["basic", "premium"]
FEATURE_EPOCH = "2025-01-01 00:00:00"
NO_EXPIRY_DAYS = 36500

TEXT_DEFAULT = "Unknown"
UNKNOWN_AGE = -1
# --------------------------------------------------------------------------


TYPES = {
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "FLOAT": T.FloatType(),
    "STRING": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
    "DATE": T.DateType(),
    "METRICS": T.MapType(T.StringType(), T.DoubleType()),
    "TEXTS": T.MapType(T.StringType(), T.StringType()),
}


def _schema(columns: str) -> T.StructType:
    """``name TYPE, ...`` to a schema without a running session (``fromDDL`` needs one)."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


# fixed values: table layouts
INTERACTIONS = _schema(
    "user_id BIGINT, product_id BIGINT, event_type STRING, timestamp BIGINT, duration_seconds DOUBLE"
)
PROFILES = _schema(
    "user_id BIGINT, age BIGINT, location_city STRING, location_country STRING, tier STRING"
)
CATALOG = _schema(
    "product_id BIGINT, product_name STRING, category_id BIGINT, category STRING, "
    "subcategory_id BIGINT, subcategory STRING, brand STRING, price DOUBLE, rating_avg DOUBLE, "
    "rating_count BIGINT, stock_quantity BIGINT"
)
CATALOG_ENVELOPE = T.StructType(
    [T.StructField("count", T.LongType()), T.StructField("products", T.ArrayType(CATALOG))]
)

USER_FEATURES = _schema(
    "user_id BIGINT, age DOUBLE, age_scaled DOUBLE, location_city STRING, location_country STRING, "
    "tier STRING, interaction_count BIGINT, activity_frequency DOUBLE, purchase_ratio DOUBLE, "
    "first_interaction TIMESTAMP, last_interaction TIMESTAMP, preferred_category STRING, "
    "category_confidence DOUBLE, created_at TIMESTAMP, updated_at TIMESTAMP"
)
PRODUCT_FEATURES = _schema(
    "product_id BIGINT, category_id BIGINT, category STRING, subcategory_id BIGINT, "
    "subcategory STRING, brand STRING, price DOUBLE, price_scaled DOUBLE, rating_avg DOUBLE, "
    "rating_count BIGINT, rating_count_log DOUBLE, stock_quantity_scaled DOUBLE, "
    "interaction_count BIGINT, unique_users BIGINT, popularity_score DOUBLE, "
    "conversion_rate DOUBLE, diversity_score DOUBLE, created_at TIMESTAMP, updated_at TIMESTAMP"
)
INTERACTION_FEATURES = _schema(
    "user_id BIGINT, product_id BIGINT, interaction_count BIGINT, implicit_score DOUBLE, "
    "hour_sin DOUBLE, hour_cos DOUBLE, day_sin DOUBLE, day_cos DOUBLE, duration_scaled DOUBLE, "
    "time_since_last_seconds BIGINT, interaction_date DATE, created_at TIMESTAMP"
)

RUNS = _schema(
    "run_id STRING, status STRING, start_time TIMESTAMP, end_time TIMESTAMP, "
    "metrics METRICS, params TEXTS, tags TEXTS"
)


def default_for(field: T.StructField):
    """Default of a missing or null feature: -1 for age, Unknown for text, 0 for numbers."""
    if field.name == "age":
        return UNKNOWN_AGE
    if isinstance(field.dataType, T.StringType):
        return TEXT_DEFAULT
    if isinstance(field.dataType, T.NumericType):
        return 0
    return None  # timestamps and dates stay null


@dataclass(frozen=True)
class FeatureView:
    """A named, typed projection of a feature table with its join keys and time to live."""

    name: str
    keys: tuple[str, ...]
    schema: T.StructType
    ttl_days: int = NO_EXPIRY_DAYS
    timestamp: str = "event_timestamp"

    @property
    def features(self) -> list[str]:
        return self.schema.fieldNames()


# fixed values: the typed features of each view
USER_VIEW = FeatureView(
    "user_features",
    ("user_id",),
    _schema(
        "age BIGINT, age_scaled FLOAT, location_city STRING, location_country STRING, tier STRING, "
        "interaction_count BIGINT, activity_frequency FLOAT, purchase_ratio FLOAT, "
        "preferred_category STRING, category_confidence FLOAT"
    ),
)
PRODUCT_VIEW = FeatureView(
    "product_features",
    ("product_id",),
    _schema(
        "category_id BIGINT, category STRING, subcategory_id BIGINT, subcategory STRING, "
        "brand STRING, price FLOAT, price_scaled FLOAT, rating_avg FLOAT, rating_count BIGINT, "
        "rating_count_log FLOAT, stock_quantity_scaled FLOAT, interaction_count BIGINT, "
        "unique_users BIGINT, popularity_score FLOAT, conversion_rate FLOAT, diversity_score FLOAT"
    ),
)
INTERACTION_VIEW = FeatureView(
    "interaction_features",
    ("user_id", "product_id"),
    _schema(
        "interaction_count BIGINT, implicit_score FLOAT, time_since_last_seconds BIGINT, "
        "duration_scaled FLOAT, hour_sin FLOAT, hour_cos FLOAT, day_sin FLOAT, day_cos FLOAT"
    ),
)
