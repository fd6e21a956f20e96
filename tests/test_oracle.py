"""Every registered query against its DuckDB counterpart on the smallest data."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from marketloom import catalog

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalog.load()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    def text(value):
        if pd.isna(value):
            return ""
        return value if isinstance(value, str) else repr(float(value))

    ordered = frame[sorted(frame.columns)]
    return sorted(tuple(text(v) for v in row) for row in ordered.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF).toPandas()
    if name not in ORACLES:
        assert len(result) > 0
        return
    expected = duck.sql(ORACLES[name])
    assert {str(t) for t in expected.types} <= {"BIGINT", "DOUBLE", "VARCHAR"}
    expected = expected.df()
    assert sorted(result.columns) == sorted(expected.columns)
    assert canonical(result) == canonical(expected)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
