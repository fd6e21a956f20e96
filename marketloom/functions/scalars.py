"""Scalar expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.schemas import EVENT_STRENGTH

LETTERS_ONLY = "^[A-Za-z]+$"  # fixed value


def event_strength(event_type: Column) -> Column:
    """view 1, click 2, add_to_cart 3, purchase 4, anything else (and null) 0."""
    expr = F.lit(0)
    for name, strength in EVENT_STRENGTH.items():
        expr = F.when(event_type == name, F.lit(strength)).otherwise(expr)
    return expr.cast("int")


def tolerant_long(column: Column, dtype: T.DataType) -> Column:
    """Integer id from any column: null or unreadable gives 0, fractions truncate toward zero.

    Integral input is only null-filled; going through DOUBLE would lose digits above 2^53.
    """
    if isinstance(dtype, T.IntegralType):
        value = column.cast("bigint")
    else:
        text = F.trim(column) if isinstance(dtype, T.StringType) else column
        value = text.try_cast("double").try_cast("bigint")
    return F.coalesce(value, F.lit(0).cast("bigint"))


def epoch_to_ts(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def hour_norm(hour: Column) -> Column:
    return hour / F.lit(23.0)


def weekday_norm(weekday: Column) -> Column:
    return weekday / F.lit(6.0)


def cyclic(value: Column, period: float) -> tuple[Column, Column]:
    """(sin, cos) position of ``value`` on a circle of ``period`` steps."""
    angle = F.lit(2.0) * F.pi() * value / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole with 0 for an empty or missing whole."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def days_between(first: Column, last: Column) -> Column:
    """Lifespan in days; an empty lifespan counts as one day."""
    days = (F.unix_micros(last) - F.unix_micros(first)) / F.lit(86400000000.0)
    return F.when(days == 0, F.lit(1.0)).otherwise(days)


def mean_timestamp_micros(sum_seconds: Column, count: Column) -> Column:
    """Mean of epoch seconds in microseconds, in integer arithmetic only.

    Quotient and remainder are scaled apart, so that the sum times 10^6 never
    has to fit a bigint.
    """
    return F.call_function("div", sum_seconds, count) * F.lit(1000000) + F.call_function(
        "div", (sum_seconds % count) * F.lit(1000000), count
    )


def strip_prefix(name: Column, prefix: str) -> Column:
    """Remove every occurrence of the one-hot prefix text."""
    return F.replace(name, F.lit(prefix), F.lit(""))


def not_letters(text: Column) -> Column:
    """True when trimmed text has anything but letters; a null passes as the word it prints as."""
    return F.coalesce(~F.trim(text).rlike(LETTERS_ONLY), F.lit(False))


def parse_day(text: Column) -> Column:
    return F.to_date(text, "yyyyMMdd")


def format_day(date: Column) -> Column:
    return F.date_format(date, "yyyyMMdd")


def before_underscore(name: Column) -> Column:
    return F.split_part(name, F.lit("_"), F.lit(1))


def metric_label(key: Column) -> Column:
    return F.initcap(F.replace(key, F.lit("_"), F.lit(" ")))


def metric_text(value: Column) -> Column:
    """Four decimals, or N/A when the metric was never logged."""
    return F.when(value.isNull(), F.lit("N/A")).otherwise(F.format_string("%.4f", value))


def run_duration(start: Column, end: Column) -> Column:
    seconds = F.call_function("div", F.unix_micros(end) - F.unix_micros(start), F.lit(1000000))
    return F.coalesce(F.concat(seconds.cast("string"), F.lit("s")), F.lit("Running"))


def iso_to_ts(text: Column) -> Column:
    """ISO-8601 text with or without time, fraction and zone; UTC when no zone is given."""
    return text.try_cast("timestamp")


def strip_key_prefix(values: Column, prefix: str) -> Column:
    """Map entries whose key starts with ``prefix``, prefix cut, null values dropped."""
    kept = F.map_filter(values, lambda k, v: k.startswith(prefix) & v.isNotNull())
    return F.transform_keys(kept, lambda k, _: F.replace(k, F.lit(prefix), F.lit("")))


def hold_out_bucket(*keys: Column) -> Column:
    """0..99, from the first 8 hex digits of the md5 of the joined keys."""
    digest = F.md5(F.concat_ws(":", *[k.cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(100)


def purchase_mask(df: DataFrame) -> Column:
    """Whether a row is a purchase, from whichever column the frame has."""
    if "event_type" in df.columns:
        return F.coalesce(F.col("event_type") == "purchase", F.lit(False))
    if "event_strength" in df.columns:
        return F.coalesce(F.col("event_strength") == EVENT_STRENGTH["purchase"], F.lit(False))
    return F.lit(False)
