from __future__ import annotations

import gzip

from pyspark.sql import functions as F

from marketloom.llm import warc

SCHEMA = "page_id bigint, url string, html string, shard string, digest int"


def pages(spark, n, extra=()):
    rows = [(i, f"http://e/{i}", f"<p>é {i}\r\n\r\nWARC/1.0 {'x' * (i % 50)}</p>", "s", 1) for i in range(n)]
    return spark.createDataFrame([*rows, *extra], SCHEMA).repartition(3)


ODD = [(None, None, None, None, None), (None, "u\r\nv", "", "s", 1), (3, "again", "other", "s", 1), (4, "http://e/4", "<p>é 4\r\n\r\nWARC/1.0 xxxx</p>", "s", 1), (500, "long", "y" * 300_000, "s", 1)]


def replica(spark, made, own, tmp_path, name):
    placed = made.join(own.select("page_id", "payload", "shard", "ordinal").dropDuplicates(["page_id", "payload"]), (made["page_id"].eqNullSafe(own["page_id"])) & (made["payload"] == own["payload"]))
    path = f"file://{tmp_path}/{name}"
    warc.write_replica(placed.select("shard", "ordinal", "record"), path, F.col("record"))
    return warc.read_replica(spark, path)


def test_round_trip_and_clean_audit(spark, tmp_path):
    made = warc.records(pages(spark, 120, ODD[1:3] + ODD[4:]))
    own = warc.index(made, 25)
    theirs = replica(spark, made, own, tmp_path, "clean")
    columns = ["page_id", "payload", "shard", "ordinal", "offset", "length", "digest"]
    assert sorted(map(str, own.select(columns).collect())) == sorted(map(str, theirs.select(columns).collect()))
    assert warc.audit(own, theirs).count() == 0


def test_damage_is_located(spark, tmp_path):
    made = warc.records(pages(spark, 120))
    own = warc.index(made, 25)
    record = F.when(F.col("page_id") == 7, F.expr("overlay(record PLACING '#' FROM char_length(record))")).otherwise(F.col("record"))
    theirs = replica(spark, made.where("page_id <> 60").withColumn("record", record), own, tmp_path, "spoiled")
    found = {r.page_id: r.status for r in warc.audit(own, theirs).collect()}
    assert found[7] == "damaged" and found[60] == "missing"
    assert {s for p, s in found.items() if p not in (7, 60)} == {"moved"}
    # only records behind the gap and under the differing node of the same shard have moved
    assert all(60 < p < 75 for p, s in found.items() if s == "moved")


def test_broken_files():
    one = b"WARC/1.0\r\nWARC-Record-ID: <urn:page:5:ab>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [r[:4] for r in warc.parse(one * 2)] == [(5, "ab", 0, len(one) - 4), (5, "ab", len(one), len(one) - 4)]
    assert len(list(warc.parse(one + one[:-10]))) == 1
    assert list(warc.parse(b"")) == list(warc.parse(b"junk")) == list(warc.parse(b"WARC/1.0\r\nno end")) == []
    packed = gzip.compress(one * 2000)
    assert warc._whole(packed) == one * 2000
    assert (one * 2000).startswith(warc._whole(packed[:-200])) and warc._whole(b"no gzip") == b""


def test_odd_pages(spark, monkeypatch):
    monkeypatch.setattr(warc, "table", lambda *_: pages(spark, 40, ODD))
    out = warc.op10_warc(spark, "").collect()
    assert len(out) == 45 and {r.status for r in out} >= {"intact"}
    monkeypatch.setattr(warc, "table", lambda *_: pages(spark, 0))
    assert warc.op10_warc(spark, "").count() == 0
