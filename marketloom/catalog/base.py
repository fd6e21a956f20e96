"""Registration and the common output form of the queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def tidy(df: DataFrame) -> DataFrame:
    """Comparable values: doubles to 6 decimals without negative zero, times as text, integers as bigint."""
    columns = []
    for field in df.schema:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), 6) + F.lit(0.0)
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(kind, (T.IntegralType, T.BooleanType)):
            c = c.cast("bigint")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def register(name: str, sql: str | None = None):
    def wrap(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(build(use_utc(spark), sf_dir.rstrip("/")))

        run.__name__, run.__doc__ = name, build.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return wrap
