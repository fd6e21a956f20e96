from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, source string"


@pytest.fixture
def docs(spark):
    """docs((id, text), (id, text, source), ...) over several partitions, with columns that clash with working names."""

    def make(*rows, parts: int = 3):
        full = [(*r, "s")[:3] if len(r) == 2 else r for r in rows]
        frame = spark.createDataFrame(full, DOCS) if full else spark.createDataFrame([], DOCS)
        extra = {"row": "1", "id": "'x'", "name": "null", "mark": "2", "size": "3", "kept": "true", "h": "5", "shard": "'t'", "node": "9", "n": "0", "level": "1"}
        extra |= {k: "7" for k in ("__id", "__digest", "__n", "__n_chars", "__mark", "__mix_source", "__mix_part", "__mix_size", "a.b", "text_mark", "copy", "digest", "taken")}
        return frame.selectExpr("*", *(f"{v} AS `{k}`" for k, v in extra.items())).repartition(parts)

    return make
