"""Lags, latest rows, top-N and dense positions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions.scalars import ratio
from marketloom.session import materialize


def lag_seconds(df: DataFrame, keys: list[str], micros: str) -> Column:
    """Whole seconds since the previous row of the key; 0 for the first."""
    previous = F.lag(micros).over(Window.partitionBy(*keys).orderBy(micros))
    return F.coalesce(F.call_function("div", F.col(micros) - previous, F.lit(1000000)), F.lit(0)).cast("bigint")


def share_of_max(df: DataFrame, column: str, output: str, fit_on: DataFrame | None = None) -> DataFrame:
    """column / global maximum. The maximum is a scalar subquery, not a one-partition window.

    ``fit_on`` may be a cheaper frame with the same values of the column.
    """
    top = (df if fit_on is None else fit_on).agg(F.max(column)).scalar()
    return df.withColumn(output, ratio(F.col(column), top))


def top_n_per_key(df: DataFrame, key: str, score: str, item: str, n: int) -> DataFrame:
    """Best ``n`` rows per key, ties to the smallest item. The limit is applied before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(score), item))
    return df.withColumn("rank", rank).where(F.col("rank") <= n)


def _having(df: DataFrame, keys: list[str], column: str, newest: bool) -> DataFrame:
    """Rows with the largest (or smallest) value of ``column`` in their key; where all are null, all rows.

    The value is a hash aggregate over a few columns, and the rows are found by a semi-join
    on the key with a range test, so whole rows are neither sorted nor buffered.
    """
    best = df.groupBy(*(F.col(k).alias(f"_of_{k}") for k in keys)).agg((F.max if newest else F.min)(column).alias("_best"))
    same = reduce(lambda x, y: x & y, (df[k].eqNullSafe(best[f"_of_{k}"]) for k in keys))
    good = df[column] >= best["_best"] if newest else df[column] <= best["_best"]
    return df.join(best, same & F.coalesce(good, best["_best"].isNull()), "left_semi")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest row per key, nulls in ``order`` coming first; of rows equal in ``order`` the one whose hash is least.

    The rows that are newest by the first order column are written once; the other columns
    only decide between those of a key that are equal in it.
    """
    marked = df.withColumn("_mark", F.xxhash64(*(F.col(f"`{c}`") for c in sorted(df.columns))))
    if order:
        marked = materialize(_having(marked, keys, order[0], True), "newest")
    for column in order[1:]:
        marked = _having(marked, keys, column, True)
    # what is left over per key is one row, or several equal ones
    return _having(marked, keys, "_mark", False).drop("_mark").distinct()


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key, the one whose hash over all columns is least: the same in any order of the rows.

    The least hash is an aggregate and the row a semi-join with it, so a key with very many
    rows is neither sorted nor gathered.
    """
    marked = df.withColumn("_mark", F.xxhash64(*(F.col(f"`{c}`") for c in sorted(df.columns))))
    least = marked.groupBy(key).agg(F.min("_mark").alias("_mark"))
    return marked.join(least, [key, "_mark"], "left_semi").dropDuplicates([key, "_mark"]).select(*df.columns)


def replace_rows(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``new`` and the rows of ``old`` whose key it lacks: an anti-join on the keys alone, no sort of whole rows."""
    own = new.select(*(F.col(k).alias(f"_new_{k}") for k in keys))
    found = reduce(lambda x, y: x & y, (old[k].eqNullSafe(own[f"_new_{k}"]) for k in keys))
    return old.join(own, found, "left_anti").unionByName(new, allowMissingColumns=True)


def keep_last(batches: list[DataFrame], keys: list[str], order: list[str] | None = None, unique: bool = False) -> DataFrame:
    """Union of the batches with one row per key: the one of the last batch that has it.

    ``order`` breaks ties inside a batch; ``unique`` says that a batch has no key twice.
    """
    own = [b if unique else latest_per_key(b, keys, order or []) for b in batches]
    return reduce(lambda old, new: replace_rows(old, new, keys), own)


def sorted_positions(df: DataFrame, *order: str) -> DataFrame:
    """Adds the 0-based ``position`` of each row in the order of the given columns.

    A ranking window over all rows would run in one task. Here the rows are range
    sorted and written once; the position is the offset of the row's partition
    plus its number in it, and only the partition sizes are ranked together.
    """
    ordered = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    numbered = materialize(ordered, "sorted").withColumns(
        {"_part": F.shiftright("_mid", 33), "_row": F.col("_mid").bitwiseAND((1 << 33) - 1)}
    )
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # one row per partition of the sort: a size that is known, whatever the data
    return numbered.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + F.col("_row")).alias("position")
    )


def key_index(df: DataFrame, key: str) -> DataFrame:
    """Dense 0-based position of each distinct non-null key in sorted order."""
    return sorted_positions(df.select(key).where(F.col(key).isNotNull()).distinct(), key)
