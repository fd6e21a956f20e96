from __future__ import annotations

import importlib.util
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from marketloom.llm import registry

from .conftest import SF

QUERIES, ORACLES = registry.load()


def test_registration():
    assert set(QUERIES) == {"pipeline", *registry.OPERATORS}
    assert {n.split("_")[0] for n in registry.OPERATORS} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "byte_bpe"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    expected = con.sql(ORACLES[name]).df()
    got = QUERIES[name](spark, SF).select(*expected.columns).toPandas()
    assert sorted(map(str, got.values.tolist())) == sorted(map(str, expected.values.tolist()))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    out = corpus_pipeline.run(spark, SF)
    assert 100 < out.count() < 400


def test_the_rest_stands_without_this_package():
    assert importlib.util.find_spec("marketloom.llm.registry")
    source = Path(contract.__file__).parent / "marketloom"
    others = [p for p in source.rglob("*.py") if "llm" not in p.parts]
    assert not [p for p in others if "marketloom.llm" in p.read_text() or "corpus_pipeline" in p.read_text()]
