"""Files, snapshots, full and incremental jobs, streaming."""

from __future__ import annotations

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketloom.operators import joins as J
from marketloom.operators import quality as Q
from marketloom.plans import curate, eda, feature_state, features, jobs, runs, training
from marketloom.schemas import CATALOG, INTERACTIONS, PROFILES, USER_VIEW
from marketloom.session import scratch_root
from marketloom.sources import files, listing, snapshots
from marketloom.streaming import jobs as streams

NOON = 1_704_110_400  # 2024-01-01 12:00 UTC
EVENTS = ["view", "click", "add_to_cart", "purchase"]


def write_drop(folder, date, interactions, profiles, products, envelope=True):
    folder.mkdir(parents=True, exist_ok=True)
    header = "user_id,product_id,event_type,timestamp,duration_seconds\n"
    (folder / f"{date}_user_interactions.csv").write_text(header + "\n".join(",".join(map(str, r)) for r in interactions))
    header = "user_id,age,location_city,location_country,tier\n"
    (folder / f"{date}_user_profiles.csv").write_text(header + "\n".join(",".join(map(str, r)) for r in profiles))
    document = {"count": len(products), "products": products} if envelope else products
    (folder / f"{date}_product_catalog.json").write_text(json.dumps(document, indent=1))


def product(i, **more):
    return {
        "product_id": i, "product_name": f"p{i}", "category_id": i % 2, "category": f"c{i % 2}", "subcategory_id": i % 3,
        "subcategory": f"s{i % 3}", "brand": "b", "price": 1.0 + i, "rating_avg": 3.0, "rating_count": 4 * i, "stock_quantity": 5, **more,
    }


PEOPLE = [(1, 30, "Oslo", "Norway", "basic"), (2, 40, "Rome", "Italy", "premium")]
DAY1 = [(1, 1, "view", NOON, 5), (1, 2, "purchase", NOON + 60, 6), (2, 1, "click", NOON + 90, 7), (1, 1, "view", NOON, 5)]
DAY2 = [(1, 1, "purchase", NOON + 86_400, 9), (3, 4, "view", NOON + 86_460, 1)]


def test_data_job_end_to_end(spark, tmp_path):
    drop, root = tmp_path / "drop", str(tmp_path / "lake")
    write_drop(drop, "20240101", DAY1, PEOPLE, [product(1), product(2)])
    assert jobs.data_job(spark, str(drop), str(drop), root) == "20240101"
    store = f"{root}/{jobs.FEATURES}"
    users = feature_state.load(spark, store, "user_features")
    row = {r["user_id"]: r for r in users.collect()}
    assert row[1]["interaction_count"] == 2 and row[1]["purchase_ratio"] == 0.5 and row[1]["tier"] == "basic"
    # the same date again does not add its counts twice
    jobs.data_job(spark, str(drop), str(drop), root, "20240101")
    assert snapshots.current_version(spark, store) == 1
    write_drop(drop, "20240102", DAY2, PEOPLE, [product(1), product(2), product(4)], envelope=False)
    assert jobs.data_job(spark, str(drop), str(drop), root) == "20240102"
    row = {r["user_id"]: r for r in feature_state.load(spark, store, "user_features").collect()}
    assert row[1]["interaction_count"] == 3 and row[2]["interaction_count"] == 1
    # user 3 has no profile
    assert row[3]["tier"] == "Unknown" and row[3]["age"] == -1
    lineage = spark.read.json(f"{root}/lineage/event_date=20240101").first()
    assert lineage["row_count"] == 3 and lineage["sources"]["user_profiles"]["ingestion_date"] == "20240101"
    write_drop(drop, "20240103", [(1, 1, "steal", NOON, 5)], PEOPLE, [product(1)])
    with pytest.raises(Q.QualityGateError, match="event_type"):
        jobs.data_job(spark, str(drop), str(drop), root)
    assert snapshots.current_version(spark, store) == 2
    with pytest.raises(FileNotFoundError):
        jobs.ingest_csv(spark, str(drop), root, "user_profiles", "19990101")


def test_partition_listing(spark, tmp_path):
    root = tmp_path / "raw"
    with pytest.raises(FileNotFoundError):
        listing.latest_partition(spark, str(root))
    for name in ("20240102", "20231231"):
        (root / f"ingestion_date={name}").mkdir(parents=True)
    assert listing.latest_partition(spark, str(root)) == "20240102"
    with pytest.raises(FileNotFoundError, match="no data files"):
        files.read_partition(spark, str(root))
    (root / "ingestion_date=soon").mkdir()
    with pytest.raises(ValueError):
        listing.latest_partition(spark, str(root))


def test_catalog_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"count": 2, "products": [product(1), product(2)]}, indent=2))
    (tmp_path / "b.json").write_text(json.dumps([product(3)], indent=2))
    (tmp_path / "broken.json").write_text('{"products": [')
    got = files.read_catalog_json(spark, str(tmp_path), CATALOG)
    assert sorted(r["product_id"] for r in got.collect()) == [1, 2, 3]


def test_a_large_document_is_read_by_many_tasks(spark, tmp_path):
    """Braces, quotes, brackets and backslashes in names; splits of a few hundred bytes end anywhere, also in strings."""
    odd = ["plain", "a } b", 'say "}" {', "end\\", "[{", "}}}", '\\"', "é 日本 }", "", '"', '\\\\"}']
    products = [product(i, product_name=odd[i % len(odd)]) for i in range(1, 400)]
    more = {"count": 399, "meta": {"pages": [{"n": 1}, {"n": 2}]}, "products": products, "errors": [{"product_id": -1}]}
    for name, document, indent in (("a", more, 2), ("b", products, None), ("c", {"count": 399, "products": products}, None)):
        (tmp_path / f"{name}.json").write_text(json.dumps(document, indent=indent, ensure_ascii=name == "b") + ("\n" if name == "c" else ""))
    (tmp_path / "empty.json").write_text(json.dumps({"count": 0, "products": []}))
    (tmp_path / "cut.json").write_text(json.dumps(products)[:-40])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        for name, n in (("a", 399), ("b", 399), ("c", 399), ("empty", 0), ("cut", 0)):
            df = files.read_catalog_json(spark, str(tmp_path / f"{name}.json"), CATALOG)
            got = sorted((r["product_id"], r["product_name"], r["price"], r["stock_quantity"]) for r in df.collect())
            assert got == [(p["product_id"], p["product_name"], p["price"], p["stock_quantity"]) for p in products][:n], name
        assert spark.read.option("lineSep", "}").text(str(tmp_path / "a.json")).rdd.getNumPartitions() > 50
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_half_written_snapshot_is_ignored(spark, tmp_path):
    root = str(tmp_path / "store")
    snapshots.save_snapshots(spark, root, {"t": spark.range(3)}, {"a": "1"})
    spark.range(9).write.parquet(f"{root}/v=000002/t")  # died before its marker
    assert snapshots.load_snapshot(spark, root, "t", spark.range(1).schema).count() == 3
    assert snapshots.save_snapshots(spark, root, {"t": spark.range(5)}, {"a": "1", "b": "2"}) == 3
    assert snapshots.load_snapshot(spark, root, "t", spark.range(1).schema).count() == 5
    assert snapshots.held_batches(spark, root) == {"a": "1", "b": "2"}
    for n in range(4):
        snapshots.save_snapshots(spark, root, {"t": spark.range(n)}, {"c": str(n)})
    assert snapshots.held_batches(spark, root) == {"c": "3"}
    # versions that no reader should still need are gone
    assert len([n for n in listing.list_names(spark, root) if listing.exists(spark, f"{root}/{n}/{snapshots.MARKER}")]) == snapshots.KEPT_VERSIONS


def test_dynamic_overwrite_keeps_other_partitions(spark, tmp_path):
    root = str(tmp_path / "raw")
    files.write_partitions(spark.createDataFrame([(1, "20240101"), (2, "20240102")], "v BIGINT, ingestion_date STRING"), root)
    files.write_partitions(spark.createDataFrame([(3, "20240102")], "v BIGINT, ingestion_date STRING"), root)
    assert sorted((r["v"], r["ingestion_date"]) for r in files.read_dates(spark, root).collect()) == [(1, "20240101"), (3, "20240102")]


def test_curation_stops_on_empty_input(spark):
    empty, profiles, catalog = (spark.createDataFrame([], s) for s in (INTERACTIONS, PROFILES, CATALOG))
    with pytest.raises(RuntimeError, match="interactions"):
        curate.curate(empty, profiles, catalog)
    some = spark.createDataFrame([(1, 1, "view", NOON, 1.0)], INTERACTIONS)
    with pytest.raises(RuntimeError, match="catalog"):
        curate.curate(some, profiles, catalog)
    one = spark.createDataFrame([tuple(product(1).values())], CATALOG)
    # missing profiles are tolerated
    assert "tier" not in curate.curate(some, profiles, one).columns


@pytest.mark.parametrize("build", [features.user_features, features.product_features, features.interaction_features])
def test_mandatory_columns(spark, build):
    with pytest.raises(ValueError, match="mandatory"):
        build(spark.createDataFrame([(1,)], "something BIGINT"))


def test_one_hot_fallback_for_categories(spark):
    schema = "user_id BIGINT, timestamp BIGINT, event_strength INT, cat_a INT, cat_b INT, tier_basic INT, tier_premium INT"
    df = spark.createDataFrame([(1, NOON, 4, 0, 1, 0, 1), (1, NOON + 1, 1, 0, 1, 0, 1), (1, NOON + 2, 1, 1, 0, 0, 1), (2, NOON, 0, 0, 0, 1, 0)], schema)
    row = {r["user_id"]: r for r in features.user_features(df).collect()}
    assert (row[1]["preferred_category"], round(row[1]["category_confidence"], 6), row[1]["tier"]) == ("b", 0.666667, "premium")
    assert (row[2]["preferred_category"], row[2]["category_confidence"]) == ("a", 0.0)
    assert round(row[1]["purchase_ratio"], 6) == 0.333333


events = st.lists(
    st.tuples(st.integers(1, 4), st.integers(1, 3), st.sampled_from(EVENTS), st.integers(NOON, NOON + 3 * 86_400)), min_size=1, max_size=25
)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=events, new=events)
def test_full_build_equals_update(spark, old, new):
    """Sums, ranges and ratios do not depend on how the rows were split into batches."""
    schema = "user_id BIGINT, product_id BIGINT, event_type STRING, timestamp BIGINT"
    a, b = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    columns = ["user_id", "interaction_count", "purchase_ratio", "first_interaction", "last_interaction", "activity_frequency"]
    full = features.user_features(a.union(b)).select(columns)
    step = features.update_users(features.user_features(a), b).select(columns)
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, step.collect()))
    columns = ["product_id", "interaction_count", "conversion_rate", "popularity_score"]
    full = features.product_features(a.union(b)).select(columns)
    step = features.update_products(features.product_features(a), b).select(columns)
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, step.collect()))


def test_update_keeps_known_attributes(spark):
    schema = "user_id BIGINT, timestamp BIGINT, event_type STRING, age DOUBLE, age_scaled DOUBLE, tier STRING, category STRING"
    old = features.user_features(spark.createDataFrame([(1, NOON, "view", 33.0, 0.5, "basic", "x")], schema))
    day = spark.createDataFrame([(1, NOON + 5, "view", None, None, None, None)], schema)
    row = features.update_users(old, day).first()
    assert (row["age"], row["age_scaled"], row["tier"], row["preferred_category"]) == (33.0, 0.5, "basic", "x")


def test_training_job_appends_runs(spark, tmp_path):
    cells = [(u, i, NOON + 3600 * (u * 7 + i), EVENTS[(u * i) % 4]) for u in range(1, 13) for i in range(1, 9) if (u + i) % 3]
    df = spark.createDataFrame(cells, "user_id BIGINT, product_id BIGINT, timestamp BIGINT, event_type STRING")
    df = df.withColumn("event_strength", F.expr("1 + user_id % 3")).withColumn("brand", F.lit("b"))
    table = features.interaction_features(df)
    products = features.product_features(df)
    ledger = training.train_and_log(table, products, str(tmp_path / "out"), str(tmp_path / "runs"), ("content",), n=3)
    assert runs.latest_run(ledger).count() == 1
    shown = runs.recent_runs(ledger).first()
    assert shown["model_type"] == "content" and shown["svd_hit_rate"] == "N/A"
    sample = spark.read.option("header", True).csv(str(tmp_path / "out" / "content_top_n"))
    assert sample.columns == ["user_id", "product_id", "similarity_score"]


def test_run_selection(spark, tmp_path):
    from datetime import datetime

    def run(name, status, day, rate):
        return runs.run_row(spark, name, status, datetime(2024, 1, day), None, {"content_hit_rate_50": rate}, {"model_type": "content"})

    path = str(tmp_path / "runs")
    for args in (("a", "FINISHED", 1, 0.9), ("b", "FINISHED", 2, 0.1), ("c", "FAILED", 3, 0.0)):
        runs.append_runs(run(*args), path)
    ledger = runs.scan_runs(spark, path)
    assert runs.best_run(ledger).first()["run_id"] == "a"
    assert runs.latest_run(ledger).first()["run_id"] == "b"
    assert [r["run_id"] for r in runs.recent_runs(ledger, 2).collect()] == ["c", "b"]


def users_of(spark, store):
    rows = feature_state.load(spark, store, "user_features").collect()
    return {r["user_id"]: r["interaction_count"] for r in rows}


EVENT_ROWS = "user_id BIGINT, product_id BIGINT, event_type STRING, timestamp BIGINT"


def test_streams_on_one_store(spark, tmp_path):
    store = str(tmp_path / "store")
    for name, count in (("a", 2), ("b", 1)):
        part = spark.createDataFrame([(1, i, "view", NOON + i) for i in range(count)], EVENT_ROWS)
        part.write.parquet(str(tmp_path / name))
        rows = spark.readStream.schema(part.schema).parquet(str(tmp_path / name))
        # started again, a query has nothing to add
        for _ in range(2):
            streams.feature_stream(spark, rows, store, str(tmp_path / f"c-{name}"), once=True).awaitTermination()
    assert users_of(spark, store) == {1: 3} and snapshots.current_version(spark, store) == 2


def test_replayed_batch_is_not_added_again(spark, tmp_path):
    source, store, checkpoint = (str(tmp_path / n) for n in ("in", "store", "c"))
    df = spark.createDataFrame([(1, 1, "view", NOON), (1, 2, "purchase", NOON)], EVENT_ROWS)
    df.write.parquet(source)
    rows = spark.readStream.schema(df.schema).parquet(source)
    run = lambda: streams.feature_stream(spark, rows, store, checkpoint, once=True).awaitTermination()
    run()
    # died after the store was written and before the stream noted it
    for name in ("0", ".0.crc"):
        (tmp_path / "c" / "commits" / name).unlink()
    run()
    assert users_of(spark, store) == {1: 2} and snapshots.current_version(spark, store) == 1


def test_upserts_of_two_streams(spark, tmp_path):
    store = str(tmp_path / "store")
    for name, value in (("a", 1), ("b", 2)):
        part = spark.createDataFrame([(value, 0), (9, value)], "k BIGINT, v BIGINT")
        part.write.parquet(str(tmp_path / name))
        rows = spark.readStream.schema(part.schema).parquet(str(tmp_path / name))
        streams.upsert_stream(spark, rows, store, "t", ["k"], ["v"], str(tmp_path / f"c-{name}"), once=True).awaitTermination()
    got = snapshots.load_snapshot(spark, store, "t", part.schema)
    assert sorted(map(tuple, got.collect())) == [(1, 0), (2, 0), (9, 2)]


def curated_day(spark, root, date, rows):
    files.write_date(spark.createDataFrame(rows, EVENT_ROWS), f"{root}/{jobs.CURATED}", date, "event_date")


def test_dates_are_held_once_and_replaced(spark, tmp_path):
    root = str(tmp_path)
    store = f"{root}/{jobs.FEATURES}"
    curated_day(spark, root, "20240102", [(1, 1, "view", NOON + 86_400), (1, 2, "view", NOON + 86_401)])
    assert jobs.feature_job(spark, root)
    # the full build holds its date already
    assert not jobs.feature_job(spark, root, incremental=True)
    assert users_of(spark, store) == {1: 2}
    # an older date that the current version lacks is added
    curated_day(spark, root, "20240101", [(1, 1, "view", NOON)])
    assert jobs.feature_job(spark, root, incremental=True, date="20240101")
    assert users_of(spark, store) == {1: 3}
    # a corrected date replaces what it gave before
    curated_day(spark, root, "20240101", [(1, 1, "view", NOON), (1, 1, "view", NOON + 5), (2, 1, "view", NOON)])
    assert jobs.feature_job(spark, root, incremental=True, date="20240101")
    assert users_of(spark, store) == {1: 4, 2: 1}
    assert not jobs.feature_job(spark, root, incremental=True, date="20240101")
    # a full build starts over and holds the newest date alone
    assert jobs.feature_job(spark, root)
    assert users_of(spark, store) == {1: 2}
    assert jobs.feature_job(spark, root, incremental=True, date="20240101")
    assert users_of(spark, store) == {1: 4, 2: 1}


def test_csv_columns_go_by_name(spark, tmp_path):
    path = tmp_path / "20240101_user_interactions.csv"
    path.write_text(
        "event_type,note,product_id,user_id,duration_seconds,timestamp\n"
        f"view,x,2.0,1,34.0,{NOON}.0\nclick,y,x3,7,,{NOON}\nview,z,,9007199254740993,1.5,soon\n"
    )
    rows = files.read_csv(spark, str(path), INTERACTIONS).collect()
    got = [(r["user_id"], r["product_id"], r["event_type"], r["timestamp"], r["duration_seconds"]) for r in rows]
    assert got == [(1, 2, "view", NOON, 34.0), (7, 0, "click", NOON, None), (9007199254740993, None, "view", None, 1.5)]
    (tmp_path / "20240101_user_profiles.csv").write_text("age,user_id\n34.0,1\n")
    with pytest.raises(ValueError, match="location_city"):
        files.read_csv(spark, str(tmp_path / "20240101_user_profiles.csv"), PROFILES)


def test_ingest_stream_lands_by_date_and_name(spark, tmp_path):
    drop, target = tmp_path / "drop", str(tmp_path / "raw")
    drop.mkdir()
    header = ["user_id,product_id,event_type,timestamp,duration_seconds", "timestamp,product_id,user_id,duration_seconds,event_type"]
    (drop / "20240101_user_interactions.csv").write_text(f"{header[0]}\n1,2,view,{NOON},5\n")
    (drop / "20240102_user_interactions.csv").write_text(f"{header[1]}\n{NOON},4,3,5,click\n")
    for _ in range(2):
        streams.ingest_stream(spark, str(drop), target, str(tmp_path / "c"), INTERACTIONS, once=True).awaitTermination()
    rows = files.read_dates(spark, target).collect()
    assert sorted((r["user_id"], r["product_id"], r["event_type"], r["ingestion_date"]) for r in rows) == [(1, 2, "view", "20240101"), (3, 4, "click", "20240102")]


def test_streamed_drops_go_through_the_jobs(spark, tmp_path):
    """What the streams land is read, checked and curated like any other drop."""
    drop, root = tmp_path / "drop", str(tmp_path / "lake")
    write_drop(drop, "20240101", DAY1, PEOPLE, [product(1)])
    targets = {n: f"{root}/{p}" for n, p in jobs.RAW.items()}

    def poll():
        for name, schema in (("user_interactions", INTERACTIONS), ("user_profiles", PROFILES)):
            part = tmp_path / name
            part.mkdir(exist_ok=True)
            for file in drop.glob(f"*_{name}.csv"):
                (part / file.name).write_text(file.read_text())
            streams.ingest_stream(spark, str(part), targets[name], str(tmp_path / f"c-{name}"), schema, once=True).awaitTermination()
        streams.catalog_stream(spark, str(drop), targets["product_catalog"], str(tmp_path / "c-catalog"), once=True).awaitTermination()

    poll()
    # a second file of the date, in another order of columns, and a newer catalog
    (drop / "20240101_late_user_interactions.csv").write_text(f"timestamp,product_id,user_id,duration_seconds,event_type\n{NOON + 7},2,2,5,click\n")
    (drop / "20240101_b_product_catalog.json").write_text(json.dumps([product(1), product(2)]))
    poll()
    raw = jobs.load_raw(spark, root)
    assert raw["user_interactions"].count() == 5 and raw["user_interactions"].columns == INTERACTIONS.fieldNames()
    assert sorted(r["product_id"] for r in raw["product_catalog"].collect()) == [1, 2]
    Q.gate(raw, coerce_first=True)
    assert jobs.curate_job(spark, root) == "20240101"
    assert spark.read.parquet(f"{root}/{jobs.CURATED}").count() == 4
    poll()
    assert jobs.load_raw(spark, root)["user_interactions"].count() == 5


def test_files_of_one_header_are_one_read(spark, tmp_path):
    for i in range(40):
        header = "user_id,product_id,event_type,timestamp,duration_seconds" if i % 2 else "product_id,user_id,event_type,timestamp,duration_seconds"
        (tmp_path / f"20240101_{i}.csv").write_text(f"{header}\n{i},{i + 100},view,{NOON},1\n")
    (tmp_path / "20240101_empty.csv").write_text("")
    df = files.read_csv(spark, [str(p) for p in sorted(tmp_path.iterdir())], INTERACTIONS)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
    assert {(r["user_id"], r["product_id"]) for r in df.collect()} == {(i, i + 100) if i % 2 else (i + 100, i) for i in range(40)}
    assert files.read_csv(spark, [str(tmp_path / "20240101_empty.csv")] * 2, INTERACTIONS).count() == 0


def test_report_is_there_after_the_gate_stops(spark, tmp_path):
    drop, root = tmp_path / "drop", str(tmp_path / "lake")
    write_drop(drop, "20240103", [(1, 1, "steal", NOON, 5)], PEOPLE, [product(1)])
    with pytest.raises(Q.QualityGateError):
        jobs.data_job(spark, str(drop), str(drop), root)
    lines = [r["value"] for r in spark.read.text(f"{root}/{jobs.QUALITY}/ingestion_date=20240103").collect()]
    assert "Total Records: 1" in lines


class FakeSession:
    """Only the settings a session would report."""

    def __init__(self, **settings):
        self.settings = {k.replace("__", "."): v for k, v in settings.items()}
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_scratch_folder_follows_the_session():
    assert scratch_root(FakeSession(spark__checkpoint__dir="hdfs://x/y/", spark__master="yarn")) == "hdfs://x/y"
    assert scratch_root(FakeSession(spark__master="local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(FakeSession(spark__master="yarn"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(FakeSession(spark__master="local-cluster[2,1,1024]"))


def test_scratch_copies_go_with_the_process(spark, tmp_path):
    from marketloom import session

    kept, session._scratch_paths = session._scratch_paths, []
    try:
        frame = session.materialize(spark.range(3), "copy")
        path = session._scratch_paths[0]
        assert frame.count() == 3 and listing.exists(spark, path)
        session.remove_scratch(spark)
        assert not listing.exists(spark, path) and not session._scratch_paths
    finally:
        session._scratch_paths = kept


def test_many_categories_and_unreadable_ids(spark, tmp_path):
    """No width limits a catalog, and unreadable ids do not multiply rows."""
    drop, root = tmp_path / "drop", str(tmp_path / "lake")
    products = [product(i, category=f"c{i}", subcategory=f"s{i}") for i in range(1, 5001)]
    write_drop(drop, "20240101", [*DAY1, ("x1", 2, "view", NOON + 1, 1), ("x2", 2, "view", NOON + 2, 1)], PEOPLE, products)
    jobs.data_job(spark, str(drop), str(drop), root)
    # as many tiers, and the functions by themselves
    tiers = spark.range(1, 5001).selectExpr("id AS user_id", "30 AS age", "'O' AS location_city", "'N' AS location_country", "concat('t', id) AS tier")
    raw = jobs.load_raw(spark, root)
    wide = curate.curate(raw["user_interactions"], tiers, raw["product_catalog"])
    assert wide.where("user_id = 1 AND product_id = 2").select("cat_hot", "subcat_hot", "tier_hot").first() == (["c2"], ["s2"], ["t1"])
    explored = eda.eda_dataset(raw["user_interactions"], tiers, raw["product_catalog"])
    assert explored.where("user_id = 1").first()["tier_hot"] == ["t1"] and len(explored.columns) < 40
    from marketloom.operators import scaling as M

    numbered = {r["value"]: r["position"] for r in M.one_hot_dictionary(tiers, "tier").collect()}
    assert numbered == {v: i for i, v in enumerate(sorted(f"t{i}" for i in range(1, 5001)))}
    curated = spark.read.parquet(f"{root}/{jobs.CURATED}")
    assert "category" in curated.columns and [c for c in curated.columns if c.startswith("cat_")] == ["cat_hot"]
    assert spark.read.parquet(f"{root}/{jobs.CATEGORIES}/event_date=20240101").where("dim LIKE 'category=%'").count() == 5000
    people = spark.createDataFrame([(i, 30 + i) for i in range(4)] + [(0, 99)] * 3, "user_id BIGINT, age BIGINT")
    events = spark.createDataFrame([(0, 1, "view", NOON, 1.0)] * 2 + [(2, 1, "view", NOON, 1.0)], INTERACTIONS)
    goods = spark.createDataFrame([(1, "a"), (1, "b")], "product_id BIGINT, category STRING")
    merged = curate.merge_curated(events, people, goods)
    assert merged.count() == 3
    # the one that stays does not depend on the order of the rows
    again = curate.merge_curated(events, people.orderBy(F.desc("age")), goods.orderBy(F.desc("category")))
    assert sorted(map(str, merged.collect())) == sorted(map(str, again.collect()))


def folder_bytes(path):
    return sum(f.stat().st_size for f in path.rglob("*.parquet"))


def test_replacing_a_date_touches_that_date_alone(spark, tmp_path):
    """Thirty dates over two months; one of the older month is corrected after the raw rows of all others are gone."""
    root, store = str(tmp_path), f"{tmp_path}/{jobs.FEATURES}"
    days = [f"202401{d:02d}" for d in range(20, 32)] + [f"202402{d:02d}" for d in range(1, 19)]

    def rows(n, more=0):
        at = NOON + 86_400 * (19 + n)
        return [(u, (u * n) % 7, EVENTS[(u + n) % 4], at + 60 * u) for u in range(1, 6 + n % 3 + more)]

    for n, day in enumerate(days):
        curated_day(spark, root, day, rows(n))
        assert jobs.feature_job(spark, root, incremental=n > 0, date=day)
    before = snapshots.current(spark, store)
    parts = before.parts["user_features"]
    # the month that is over is one part more, which a merge reads instead of its dates
    assert sorted(feature_state.live_parts(parts)) == [*days[12:], "m202401"]
    assert len(before.parts["interaction_features"]) == 30
    for day in days[:5] + days[6:]:
        for file in (tmp_path / jobs.CURATED / f"event_date={day}").iterdir():
            file.unlink()
    curated_day(spark, root, days[5], rows(5, 4))
    assert jobs.feature_job(spark, root, incremental=True, date=days[5])
    after = snapshots.current(spark, store)
    changed = {n: {p for p in own if before.parts[n].get(p) != own[p]} for n, own in after.parts.items()}
    assert changed["user_features"] == changed["product_features"] == {days[5], "m202401"}
    assert changed["interaction_features"] == {days[5]} and changed["interaction_days"] == {f"{days[5]}|{days[5]}"}
    # all rows at once give the same tables
    every = [r for n in range(30) for r in rows(n, 4 if n == 5 else 0)]
    df = spark.createDataFrame(every, EVENT_ROWS)
    for name, build in (("user_features", features.user_features), ("product_features", features.product_features), ("interaction_features", features.interaction_features)):
        # these add up or carry over per batch by definition
        skip = {"created_at", "updated_at", "unique_users", "diversity_score", "time_since_last_seconds"}
        columns = [c for c in build(df).columns if c not in skip]
        got = feature_state.load(spark, store, name).select(columns).collect()
        assert sorted(map(str, got)) == sorted(map(str, build(df).select(columns).collect()))


def test_an_update_writes_in_proportion_to_its_batch(spark, tmp_path):
    root, store = str(tmp_path), f"{tmp_path}/{jobs.FEATURES}"
    many = [(u, u % 50, EVENTS[u % 4], NOON + u) for u in range(20_000)]
    curated_day(spark, root, "20240101", many)
    jobs.feature_job(spark, root)
    curated_day(spark, root, "20240102", [(1, 1, "view", NOON + 86_400), (2, 2, "view", NOON + 86_401)])
    jobs.feature_job(spark, root, incremental=True)
    first, second = (folder_bytes(tmp_path / jobs.FEATURES / f"v={n:06d}") for n in (1, 2))
    assert second < first / 10
    assert feature_state.load(spark, store, "interaction_features").count() == 20_002
    assert users_of(spark, store)[1] == 2


def test_a_date_in_two_batches_and_its_return(spark, tmp_path):
    """The last batch with a (user, product, date) wins; without it the row of the batch before is there again."""
    root, store = str(tmp_path), f"{tmp_path}/{jobs.FEATURES}"
    late = [(1, 1, "view", NOON), (1, 1, "view", NOON + 1), (1, 1, "view", NOON + 2)]
    for day, part in (("20240101", [(1, 1, "view", NOON), (2, 1, "view", NOON)]), ("20240102", [*late, (3, 3, "view", NOON + 86_400)])):
        curated_day(spark, root, day, part)
        jobs.feature_job(spark, root, incremental=day != "20240101", date=day)

    def counts():
        return {(r["user_id"], r["product_id"]): r["interaction_count"] for r in feature_state.load(spark, store, "interaction_features").collect()}

    assert counts() == {(1, 1): 3, (2, 1): 1, (3, 3): 1}
    curated_day(spark, root, "20240102", [(3, 3, "view", NOON + 86_400)])
    jobs.feature_job(spark, root, incremental=True, date="20240102")
    assert counts() == {(1, 1): 1, (2, 1): 1, (3, 3): 1}
    # an older version is still whole for its readers
    assert feature_state.load(spark, store, "interaction_features", snapshots.read_version(spark, store, 2)).count() == 3


def test_streamed_batches_are_compacted(spark, tmp_path):
    store = str(tmp_path / "store")
    for n in range(feature_state.FAN + 2):
        df = spark.createDataFrame([(1, 1, "view", NOON + n), (n + 10, 2, "purchase", NOON + n)], EVENT_ROWS)
        feature_state.put(spark, store, snapshots.current(spark, store), "query:q", str(n), df, "2025-01-01", None)
    version = snapshots.current(spark, store)
    assert sorted(p.split("-")[0] for p in version.parts["user_features"]) == ["s0", "s0", "s1"]
    assert users_of(spark, store) == {1: 10, **{n + 10: 1 for n in range(10)}}
    got = {(r["user_id"], r["interaction_count"]) for r in feature_state.load(spark, store, "interaction_features").collect()}
    assert got == {(1, 1), *((n + 10, 1) for n in range(10))}


def test_upsert_writes_only_parts_of_the_batch(spark, tmp_path):
    store, schema = str(tmp_path / "store"), "k BIGINT, d DATE, v BIGINT"
    source = str(tmp_path / "in")

    def run(values):
        spark.createDataFrame(values, "k BIGINT, d STRING, v BIGINT").selectExpr("k", "date(d) AS d", "v").write.mode("append").parquet(source)
        rows = spark.readStream.schema(schema).parquet(source)
        streams.upsert_stream(spark, rows, store, "t", ["k", "d"], ["v"], str(tmp_path / "c"), once=True, part="d").awaitTermination()

    run([(i, f"2024-01-{1 + i % 9:02d}", i) for i in range(90)] + [(None, None, 1)])
    before = snapshots.current(spark, store).parts["t"]
    run([(0, "2024-01-01", 7), (0, "2024-01-01", 5), (500, "2024-02-01", 1), (None, None, 2)])
    after = snapshots.current(spark, store).parts["t"]
    assert {p for p in after if after[p] != before.get(p)} == {"2024-01-01", "2024-02-01", "none"}
    got = [tuple(r) for r in snapshots.load_snapshot(spark, store, "t", spark.read.parquet(source).schema).selectExpr("k", "string(d)", "v").collect()]
    assert len(got) == 92 and {(0, "2024-01-01", 7), (500, "2024-02-01", 1), (None, None, 2)} <= set(got)


def test_training_from_the_store_sees_the_features_of_the_time(spark, tmp_path):
    """Two published versions: an interaction of the first one gets the older user features."""
    root, store, views = str(tmp_path), f"{tmp_path}/{jobs.FEATURES}", f"{tmp_path}/{training.VIEWS}"
    assert feature_state.publish(spark, store, views, "2025-01-01") is None
    cells = [(u, i, EVENTS[(u * i) % 4], NOON + 60 * (u * 7 + i)) for u in range(1, 13) for i in range(1, 9) if (u + i) % 3]
    curated_day(spark, root, "20240101", cells)
    jobs.feature_job(spark, root, as_of="2025-01-01 00:00:00")
    assert feature_state.publish(spark, store, views, "2025-01-01 00:00:00") == 1
    assert feature_state.publish(spark, store, views, "2025-01-01 00:00:00") is None
    curated_day(spark, root, "20240102", [(1, 1, "view", NOON + 86_400), (1, 2, "view", NOON + 86_400)])
    jobs.feature_job(spark, root, incremental=True, as_of="2025-02-01 00:00:00")
    assert feature_state.publish(spark, store, views, "2025-02-01 00:00:00") == 2
    rows = training.training_set_of(spark, views).where("user_id = '1'").collect()
    older = sum(1 for u, *_ in cells if u == 1)
    assert {r["user_features__interaction_count"] for r in rows if str(r["interaction_date"]) == "2024-01-01"} == {older}
    assert {r["user_features__interaction_count"] for r in rows if str(r["interaction_date"]) == "2024-01-02"} == {older + 2}
    every = snapshots.history(spark, views, "user_features", feature_state.published_schema("user_features"))
    spans = {(str(r["valid_from"])[:7], str(r["valid_to"])[:7]) for r in J.validity(every, USER_VIEW).where("user_id = '1'").collect()}
    # nothing changed for the other users, so their first row goes on
    assert spans == {("2025-01", "2025-02"), ("2025-02", "None")}
    assert J.validity(every, USER_VIEW).count() == 13
    ledger = training.train_job(spark, root, f"{root}/out", f"{root}/runs", models=("content",), n=3)
    assert runs.latest_run(ledger).count() == 1
