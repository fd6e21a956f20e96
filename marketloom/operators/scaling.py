"""Exact medians, min-max scaling and one-hot encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.operators.windows import sorted_positions
from marketloom.session import materialize

ONE_HOT_WIDTH = 1_000


def exact_medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    """Exact interpolated medians, nulls ignored, of all columns in one pass and by one way for all sizes.

    Values are counted per (column, value), which combines before the shuffle, and range
    sorted. The weight of each partition of the sort says in which one the middle ranks lie,
    and only there counts are added up in order: no column is ever gathered in one task, and
    two numbers per column come to the driver.
    """
    if not columns:
        return {}
    cells = [F.struct(F.lit(i).alias("c"), F.col(f"`{c}`").cast("double").alias("v")) for i, c in enumerate(columns)]
    long = df.select(F.inline(F.array(*cells))).where("v IS NOT NULL")
    counts = long.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    ordered = materialize(counts.orderBy("c", "v").withColumn("part", F.spark_partition_id()), "median")
    # one row per column and partition of the sort
    own = Window.partitionBy("c")
    before = F.coalesce(F.sum("held").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = ordered.groupBy("c", "part").agg(F.sum("n").alias("held")).select("c", "part", "held", before.alias("before"), F.sum("held").over(own).alias("total"))
    middle = F.array_distinct(F.array(F.expr("(total - 1) div 2"), F.expr("total div 2")))
    wanted = parts.withColumn("rank", F.explode(middle)).where("before <= rank AND rank < before + held")
    near = ordered.join(wanted.select("c", "part", (F.col("rank") - F.col("before")).alias("place")), ["c", "part"])
    upto = F.sum("n").over(Window.partitionBy("c", "part", "place").orderBy("v"))
    found = near.withColumn("upto", upto).where("upto > place").groupBy("c", "part", "place").agg(F.min("v").alias("v"))
    ends: dict[int, list[float]] = {}
    for c, v in found.select("c", "v").collect():
        ends.setdefault(c, []).append(v)
    return {name: min(ends[i]) + (max(ends[i]) - min(ends[i])) / 2.0 if i in ends else None for i, name in enumerate(columns)}


def impute_medians(df: DataFrame, *columns: str) -> DataFrame:
    """Fill nulls with the exact median; the fitted values enter the plan as literals."""
    medians = exact_medians(df, list(columns))
    return df.withColumns(
        {
            c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c]).cast("double"))
            for c in columns
        }
    )


def scaled(value: Column, low: Column, high: Column) -> Column:
    """(value - low) / (high - low); 0 for a constant column, null stays null."""
    span = high - low
    return F.when(value.isNull(), F.lit(None).cast("double")).when(
        span == 0, F.lit(0.0)
    ).otherwise((value - low) / span)


def min_max_scale(df: DataFrame, outputs: dict[str, str], fit_on: DataFrame | None = None) -> DataFrame:
    """Add ``outputs[c]`` = min-max scaled ``c``.

    The range is one scalar subquery over ``fit_on`` (default: ``df``) that reads
    only the scaled columns. Callers pass the frame before de-duplication: copies
    of a row do not move a minimum or maximum, and the fit then needs no shuffle.
    """
    source = fit_on if fit_on is not None else df
    ranges = source.agg(
        F.struct(
            *[F.min(F.col(c).cast("double")).alias(f"lo_{i}") for i, c in enumerate(outputs)],
            *[F.max(F.col(c).cast("double")).alias(f"hi_{i}") for i, c in enumerate(outputs)],
        ).alias("r")
    ).scalar()
    # held in a column, so that the plan has the subquery once and not once per use
    held = df.withColumn("_range", ranges)
    return held.withColumns(
        {
            name: scaled(
                F.col(c).cast("double"), F.col(f"_range.lo_{i}"), F.col(f"_range.hi_{i}")
            )
            for i, (c, name) in enumerate(outputs.items())
        }
    ).drop("_range")


def distinct_values_of(df: DataFrame, columns: list[str], limit: int = ONE_HOT_WIDTH) -> dict[str, list[str]]:
    """Sorted distinct non-null values of each column, all from one job.

    More than ``limit`` values in a column is an error, not a cut.
    """
    if not columns:
        return {}
    cells = [F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns]
    rows = (
        df.select(F.inline(F.array(*cells)))
        .where("v IS NOT NULL")
        .distinct()
        .limit(limit * len(columns) + 1)
        .collect()
    )
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in rows:
        found[row["c"]].append(row["v"])
    # if one column alone exhausts the joint limit, the others may look short: still an error
    for column, values in found.items():
        if len(values) > limit:
            raise ValueError(
                f"{column} has more than {limit} values: too wide for columns, use one_hot_long"
            )
    return {c: sorted(v) for c, v in found.items()}


def distinct_values(df: DataFrame, column: str, limit: int = ONE_HOT_WIDTH) -> list[str]:
    return distinct_values_of(df, [column], limit)[column]


def one_hot(df: DataFrame, column: str, prefix: str, values: list[str] | None = None) -> DataFrame:
    """0/1 columns ``prefix_value`` in value order; a null row is all zero."""
    if values is None:
        values = distinct_values(df, column)
    text = F.col(column).cast("string")
    return df.withColumns(
        {f"{prefix}_{v}": F.coalesce((text == v).cast("int"), F.lit(0)) for v in values}
    )


def one_hot_sparse(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """``prefix_hot``: the names whose flag is 1, as an array, in place of one column per value; a null row has none.

    ``one_hot_dictionary`` numbers the names; no number of values is too large.
    """
    text = F.col(f"`{column}`").cast("string")
    return df.withColumn(f"{prefix}_hot", F.when(text.isNull(), F.array().cast("array<string>")).otherwise(F.array(text)))


def one_hot_dictionary(df: DataFrame, column: str) -> DataFrame:
    """(value, position) of the distinct non-null values in their order: the columns that wide flags would have."""
    values = df.select(F.col(f"`{column}`").cast("string").alias("value")).where("value IS NOT NULL").distinct()
    return sorted_positions(values, "value")


def one_hot_long(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """(key, dim, value=1) rows for any number of distinct values; null is its own value."""
    dims = F.array(
        *[
            F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("None")))
            for c in columns
        ]
    )
    return df.select(key, F.explode(dims).alias("dim")).withColumn("value", F.lit(1.0))
