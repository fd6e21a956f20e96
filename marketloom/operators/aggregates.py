"""Grouped aggregates. Null group keys are dropped, as the data model requires."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.scalars import purchase_mask, ratio, strip_prefix
from marketloom.operators.cleaning import drop_null_keys
from marketloom.schemas import TEXT_DEFAULT

def rows() -> Column:
    return F.count(F.lit(1))


def count_by_key(df: DataFrame, *keys: str) -> DataFrame:
    return drop_null_keys(df, *keys).groupBy(*keys).agg(rows().alias("n"))


def sum_or_zero(column: Column) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def conditional_ratio(df: DataFrame, key: str, mask: Column | None = None) -> DataFrame:
    """Rows, masked rows and their share per key, from one aggregate."""
    mask = purchase_mask(df) if mask is None else mask
    counted = drop_null_keys(df, key).groupBy(key).agg(
        rows().alias("n"), F.count_if(mask).alias("hits")
    )
    return counted.withColumn("share", ratio(F.col("hits"), F.col("n")))


def category_counts(df: DataFrame, key: str, column: str) -> DataFrame:
    """Rows per (key, value): the partial result that mode and top share are built from."""
    return drop_null_keys(df, key).groupBy(key, column).agg(rows().alias("n"))


def top_value(column: str, count: str = "n") -> Column:
    """Most frequent non-null value over counted rows, ties to the smallest value."""
    return F.min_by(
        F.col(column),
        F.when(F.col(column).isNotNull(), F.struct((-F.col(count)).alias("a"), F.col(column).alias("b"))),
    )


def top_fraction(column: str, count: str = "n") -> Column:
    """Share of the most frequent value among non-null values; 0 when all are null."""
    known = F.when(F.col(column).isNotNull(), F.col(count))
    return F.coalesce(F.max(known) / F.sum(known), F.lit(0.0))


def mode_by_key(df: DataFrame, key: str, column: str) -> DataFrame:
    """Mode per key from (key, value) counts, so a hot key is reduced before it meets itself."""
    return (
        category_counts(df, key, column)
        .groupBy(key)
        .agg(F.coalesce(top_value(column), F.lit(TEXT_DEFAULT)).alias("top_value"))
    )


def top_share(df: DataFrame, key: str, column: str) -> DataFrame:
    return category_counts(df, key, column).groupBy(key).agg(top_fraction(column).alias("top_share"))


def first_known(column: str, order: str) -> Column:
    """First non-null value in ``order``; equal orders resolve to the smallest value."""
    return F.min_by(
        F.col(column),
        F.when(F.col(column).isNotNull(), F.struct(F.col(order), F.col(column))),
    )


def last_known(column: str, order: str) -> Column:
    return F.max_by(
        F.col(column),
        F.when(F.col(column).isNotNull(), F.struct(F.col(order), F.col(column))),
    )


def first_non_null(df: DataFrame, key: str, columns: list[str], order: str) -> DataFrame:
    """First non-null value of each column per key.

    The attributes hardly vary within a key, so they are first used as grouping
    keys beside it: that step is a hash aggregate with a numeric buffer and leaves
    a few rows per key for the text-valued ``min_by``.
    """
    slim = drop_null_keys(df, key).groupBy(key, *columns).agg(F.min(order).alias("_at"))
    return slim.groupBy(key).agg(*[first_known(c, "_at").alias(c) for c in columns])


RULES = {
    "sum": lambda c, seq: sum_or_zero(F.col(c)),
    "min": lambda c, seq: F.min(c),
    "max": lambda c, seq: F.max(c),
    "first": first_known,
    "last": last_known,
}


def rule_aggregate(df: DataFrame, key: str, rules: dict[str, str], seq: str) -> DataFrame:
    """One rule per column (sum, min, max, first, last) over batches numbered by ``seq``."""
    return df.groupBy(key).agg(
        *[RULES[rule](c, seq).alias(c) for c, rule in rules.items() if c in df.columns]
    )


def argmax_columns(columns: list[str], prefix: str) -> Column:
    """Name of the largest column without its one-hot prefix; ties go to the first column."""
    ranked = F.array(
        *[
            F.struct(
                F.col(c).cast("double").alias("v"), F.lit(-i).alias("p"), F.lit(c).alias("name")
            )
            for i, c in enumerate(columns)
        ]
    )
    return strip_prefix(F.array_max(ranked)["name"], prefix)


def argmax_one_hot(df: DataFrame, key: str, columns: list[str], prefix: str, how: str = "sum") -> DataFrame:
    reduce = F.sum if how == "sum" else F.max
    return (
        drop_null_keys(df, key)
        .groupBy(key)
        .agg(*[reduce(F.col(f"`{c}`")).alias(c) for c in columns])
        .select(key, argmax_columns(columns, prefix).alias("top_name"))
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(rows().alias("n"))


def top_counts(df: DataFrame, column: str, k: int) -> DataFrame:
    return value_counts(df, column).orderBy(F.desc("n"), column).limit(k)


def correlation_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every column pair, pairwise complete, as (a, b, r) rows."""
    pairs = list(combinations_with_replacement(columns, 2))
    one = df.agg(*[F.corr(a, b).alias(f"r_{i}") for i, (a, b) in enumerate(pairs)])
    entries = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            entries.append(F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"r_{i}").alias("r")))
    return one.select(F.inline(F.array(*entries)))


def duplicate_rows(df: DataFrame, *keys: str) -> DataFrame:
    """Rows beyond the first of each distinct row (or key); nulls are equal to each other."""
    groups = df.groupBy(*(keys or df.columns)).agg(rows().alias("_n"))
    return groups.agg(sum_or_zero(F.col("_n") - 1).alias("duplicates"))


def null_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
        F.count_if(F.greatest(*[F.col(c).isNull() for c in columns])).alias("null_any"),
    )


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Counts in ``bins`` equal-width bins over the data range; the last edge is inclusive.

    A single-valued column is centred in a range of width 1.
    """
    ends = df.agg(
        F.struct(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi")).alias("r")
    ).scalar()
    held = df.where(F.col(column).isNotNull()).withColumn("_ends", ends)
    lo, hi = F.col("_ends.lo"), F.col("_ends.hi")
    low = F.when(lo == hi, lo - 0.5).otherwise(lo)
    width = F.when(lo == hi, F.lit(1.0)).otherwise(hi - lo)
    place = F.floor((F.col(column).cast("double") - low) / width * F.lit(float(bins)))
    counted = held.groupBy(F.least(place, F.lit(bins - 1)).cast("bigint").alias("bin")).agg(rows().alias("n"))
    every = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return every.join(counted, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def sparsity(df: DataFrame, user: str, item: str) -> DataFrame:
    """1 - n / (users * items); null without users or items. Repeats count, so it may be negative."""
    cells = F.col("users") * F.col("items")
    return df.agg(
        F.count_distinct(user).alias("users"), F.count_distinct(item).alias("items"), rows().alias("n")
    ).withColumn("sparsity", F.when(cells > 0, 1.0 - F.col("n") / cells))


def cold_start(df: DataFrame, user: str, below: int = 5) -> DataFrame:
    return count_by_key(df, user).agg(F.count_if(F.col("n") < below).alias("cold_users"))


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """RMSE, MAE and R2. Centred sums come from one pass over the rows."""
    error = F.col(actual) - F.col(predicted)
    return df.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1.0 - F.try_divide(F.sum(error * error), F.var_pop(actual) * F.count(actual))).alias("r2"),
    )
