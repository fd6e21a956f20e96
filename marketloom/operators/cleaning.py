"""Null handling, casts, de-duplication and schema alignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions.scalars import tolerant_long
from marketloom.schemas import default_for


def present(df: DataFrame, *names: str) -> list[str]:
    return [n for n in names if n in df.columns]


def require(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing mandatory columns: {missing}")
    return df


def drop_null_keys(df: DataFrame, *keys: str) -> DataFrame:
    """As plain IS NOT NULL tests, which reach the Parquet scan."""
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Per-column default for nulls, for those columns that exist.

    Unlike ``na.fill`` it never skips a column whose type differs from the default's.
    """
    known = {n: v for n, v in defaults.items() if n in df.columns}
    return df.withColumns(
        {n: F.coalesce(F.col(n), F.lit(v).cast(df.schema[n].dataType)) for n, v in known.items()}
    )


def tolerant_ids(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns(
        {n: tolerant_long(F.col(n), df.schema[n].dataType) for n in present(df, *names)}
    )


def aligned_columns(df: DataFrame, schema: T.StructType) -> list[Column]:
    columns = []
    for field in schema:
        value = F.col(field.name).cast(field.dataType) if field.name in df.columns else None
        default = default_for(field)
        fallback = F.lit(default).cast(field.dataType)
        if value is None:
            value = fallback
        elif default is not None:
            value = F.coalesce(value, fallback)
        columns.append(value.alias(field.name))
    return columns


def align_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in order; missing or null values take the default."""
    return df.select(*aligned_columns(df, schema))


def id_to_string(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("string") for n in present(df, *names)})


def strip_view_prefix(df: DataFrame) -> DataFrame:
    """Keep the text after the last ``__`` of each column name; a clash is an error."""
    renames = {n: n.rsplit("__", 1)[-1] for n in df.columns}
    names = list(renames.values())
    clashes = sorted({n for n in names if names.count(n) > 1 or not n})
    if clashes:
        raise ValueError(f"column names clash after removing the view prefix: {clashes}")
    return df.withColumnsRenamed(renames)


def with_audit(df: DataFrame, as_of: Column) -> DataFrame:
    return df.withColumns({"created_at": as_of, "updated_at": as_of})


def union_by_name(*frames: DataFrame) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def flatten_structs(df: DataFrame) -> DataFrame:
    """Nested objects become columns with dotted names; arrays are left as they are."""

    def leaves(schema: T.StructType, path: tuple[str, ...]):
        for field in schema:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here)
            else:
                quoted = ".".join(f"`{part}`" for part in here)
                yield F.col(quoted).alias(".".join(here))

    return df.select(*leaves(df.schema, ()))
