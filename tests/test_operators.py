"""Hand-made rows for the semantic corners of the operators."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marketloom.functions import scalars as S
from marketloom.functions import vectors as V
from marketloom.operators import aggregates as A
from marketloom.operators import cleaning as C
from marketloom.operators import joins as J
from marketloom.operators import quality as Q
from marketloom.operators import scaling as M
from marketloom.operators import windows as W
from marketloom.schemas import USER_FEATURES


def values(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_mode_tie_takes_smallest(rows):
    df = rows("u BIGINT, c STRING", (1, "b"), (1, "a"), (1, "a"), (1, "b"), (2, None))
    assert values(A.mode_by_key(df, "u", "c"), "u", "top_value") == [(1, "a"), (2, "Unknown")]
    assert values(A.top_share(df, "u", "c"), "u", "top_share") == [(1, 0.5), (2, 0.0)]


def test_tolerant_cast(rows):
    texts = ["3.7", "x", None, "-3.7", " 3 ", "1e3", "NaN", "1e300"]
    df = rows("i BIGINT, t STRING", *enumerate(texts))
    got = [r["t"] for r in C.tolerant_ids(df, "t").orderBy("i").collect()]
    assert got == [3, 0, 0, -3, 3, 1000, 0, 0]
    big = rows("t BIGINT", (2**53 + 1,), (None,))
    assert {r["t"] for r in C.tolerant_ids(big, "t").collect()} == {2**53 + 1, 0}


@pytest.mark.parametrize("partitions", [1, 13])
def test_exact_median(rows, spark, partitions):
    rng = random.Random(7)
    wide = [rng.randint(-50, 50) / 4 for _ in range(400)] + [3.25] * 200
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": str(partitions)}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    columns = {"a": [1, 2, 3, 4, None], "b": [5.0], "c": [1, 1, 1, 9], "d": wide, "e": [1, 2], "f": [], "a.b": [-7, 8, 100]}
    expected = {}
    for name, data in columns.items():
        known = sorted(v for v in data if v is not None)
        mid = len(known) // 2
        expected[name] = None if not known else known[mid] if len(known) % 2 else (known[mid - 1] + known[mid]) / 2
    long = [tuple(float(data[i]) if i < len(data) and data[i] is not None else None for data in columns.values()) for i in range(600)]
    df = rows(", ".join(f"`{c}` DOUBLE" for c in columns), *long)
    assert M.exact_medians(df, list(columns)) == expected
    for n, v in before.items():
        spark.conf.set(n, v)
    empty = rows("v DOUBLE", (None,))
    assert M.exact_medians(empty, ["v"])["v"] is None


def test_min_max_constant_and_null(rows):
    df = rows("a DOUBLE, b DOUBLE", (5.0, 1.0), (5.0, None), (5.0, 3.0))
    got = M.min_max_scale(df, {"a": "x", "b": "y"}).collect()
    assert [(r["x"], r["y"]) for r in got] == [(0.0, 0.0), (0.0, None), (0.0, 1.0)]


def test_one_hot(rows):
    df = M.one_hot(rows("c STRING", ("b",), (None,), ("a",)), "c", "cat")
    assert [(r["cat_a"], r["cat_b"]) for r in df.collect()] == [(0, 1), (0, 0), (1, 0)]
    with pytest.raises(ValueError, match="one_hot_long"):
        M.distinct_values(rows("c STRING", ("a",), ("b",)), "c", limit=1)


def test_first_and_last_known(rows):
    df = rows("k BIGINT, s BIGINT, c STRING", (1, 0, None), (1, 1, "x"), (1, 2, "y"), (1, 3, None), (2, 0, None))
    got = A.rule_aggregate(df, "k", {"c": "first"}, "s").collect()
    assert {r["k"]: r["c"] for r in got} == {1: "x", 2: None}
    got = A.rule_aggregate(df, "k", {"c": "last"}, "s").collect()
    assert {r["k"]: r["c"] for r in got} == {1: "y", 2: None}
    assert values(A.first_non_null(df.where("k = 1"), "k", ["c"], "s"), "c") == [("x",)]


def test_argmax_ties_and_zero_rows(rows):
    df = rows("k BIGINT, cat_a BIGINT, cat_b BIGINT", (1, 0, 0), (2, 1, 1), (3, 0, 1))
    assert values(A.argmax_one_hot(df, "k", ["cat_a", "cat_b"], "cat_"), "k", "top_name") == [(1, "a"), (2, "a"), (3, "b")]


def test_duplicates_count_nulls_as_equal(rows):
    df = rows("a BIGINT", (1,), (1,), (1,), (None,), (None,))
    assert A.duplicate_rows(df).first()[0] == 3


def test_null_rules_of_ranges(rows):
    df = rows("x DOUBLE", (1.0,), (None,))
    assert df.agg(Q._invalid(F.col("x").between(0, 3))).first()[0] == 1
    assert df.agg(F.count_if(F.col("x") < 0)).first()[0] == 0


def test_unique_counts_every_repeated_row(rows):
    df = rows("x BIGINT", (1,), (1,), (2,), (None,), (None,))
    assert Q.run_checks(df, "d", [Q.unique("x")]).first()["unexpected"] == 2


def test_letters(rows):
    df = rows("t STRING", (" Oslo ",), (None,), ("A1",), ("",))
    assert [r[0] for r in df.select(S.not_letters(F.col("t"))).collect()] == [False, False, True, True]


def test_lifespan(rows):
    df = rows("a BIGINT, b BIGINT", (10, 10), (10, 11))
    days = S.days_between(S.epoch_to_ts(F.col("a")), S.epoch_to_ts(F.col("b")))
    assert [round(2 / r[0], 6) if i else r[0] for i, r in enumerate(df.select(days).collect())] == [1.0, 172800.0]


def test_mean_timestamp_keeps_microseconds(rows):
    df = rows("s BIGINT, n BIGINT", (3, 2), (1_700_000_000 * 3 + 1, 3), (1_700_000_000 * 10**9, 10**9))
    got = [r[0] for r in df.select(S.mean_timestamp_micros(F.col("s"), F.col("n"))).collect()]
    assert got == [1_500_000, 1_700_000_000_333_333, 1_700_000_000_000_000]


def test_zero_vector(rows):
    df = rows("a ARRAY<DOUBLE>, b ARRAY<DOUBLE>", ([0.0, 0.0], [1.0, 2.0]), ([1.0, 0.0], [2.0, 0.0]))
    assert [r[0] for r in df.select(V.cosine(F.col("a"), F.col("b"))).collect()] == [0.0, 1.0]


def test_keep_last(rows):
    first = rows("k STRING, v BIGINT", ("k1", 1), ("k2", 2))
    second = rows("k STRING, v BIGINT", ("k1", 3))
    assert values(W.keep_last([first, second], ["k"]), "k", "v") == [("k1", 3), ("k2", 2)]


def test_histogram_edges(rows):
    counts = A.histogram(rows("x BIGINT", (0,), (1,), (100,)), "x", 50)
    got = {r["bin"]: r["n"] for r in counts.collect()}
    assert len(got) == 50 and got[0] == 2 and got[49] == 1 and sum(got.values()) == 3
    same = {r["bin"]: r["n"] for r in A.histogram(rows("x BIGINT", (7,), (7,)), "x", 50).collect()}
    assert same[25] == 2


def test_key_index_is_dense_and_sorted(rows):
    rng = random.Random(1)
    keys = [rng.randint(0, 10_000) for _ in range(2_000)]
    got = W.key_index(rows("k BIGINT", *[(k,) for k in keys], (None,)), "k").collect()
    assert {r["k"]: r["position"] for r in got} == {k: i for i, k in enumerate(sorted(set(keys)))}


def test_strip_view_prefix_clash(rows):
    with pytest.raises(ValueError, match="clash"):
        C.strip_view_prefix(rows("a__x BIGINT, b__x BIGINT", (1, 2)))


def test_align_schema_defaults(rows):
    row = C.align_schema(rows("user_id BIGINT, tier STRING", (1, None)), USER_FEATURES).first()
    assert (row["age"], row["tier"], row["interaction_count"], row["first_interaction"]) == (-1.0, "Unknown", 0, None)


def test_suffix_of_clashing_columns(rows):
    joined = J.left_join(rows("k BIGINT, v BIGINT", (1, 2)), rows("k BIGINT, v BIGINT", (1, 9), (1, 8)), "k", "_r")
    assert values(joined, "k", "v", "v_r") == [(1, 2, 8), (1, 2, 9)]


# --- point-in-time join ---------------------------------------------------


def brute_asof(entities, features, ttl):
    out = []
    for i, k, t in entities:
        hits = [(ft, v) for fk, ft, v in features if fk == k and k is not None and t is not None and ft <= t]
        best = max(hits) if hits else None
        out.append((i, best[1] if best and t - best[0] <= ttl else None))
    return sorted(out)


@pytest.fixture
def many_partitions(spark):
    """Keeps partitions of few rows apart, so that a key spreads over several."""
    names = ["spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions"]
    before = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("false", "13")):
        spark.conf.set(n, v)
    yield
    for n, v in zip(names, before):
        spark.conf.set(n, v)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_asof_matches_brute_force(rows, many_partitions, seed):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)

    def when():
        return start + timedelta(minutes=rng.randint(0, 600))

    # one key holds most rows on both sides
    def key():
        return 0 if seed == 3 or rng.random() < 0.6 else rng.randint(1, 5)

    features = [(key(), when(), float(i)) for i in range(150)]
    entities = [(i, key(), when()) for i in range(200)] + [(200, 99, start), (201, None, start), (202, 0, None)]
    ttl = timedelta(minutes=30)
    got = J.asof_join(
        rows("i BIGINT, k BIGINT, t TIMESTAMP", *entities),
        rows("k BIGINT, t TIMESTAMP, v DOUBLE", *features),
        ["k"], ["v"], int(ttl.total_seconds() * 1e6), "t", "t",
    )
    assert sorted((r["i"], r["v"]) for r in got.collect()) == brute_asof(entities, features, ttl)


def test_asof_of_one_key_that_owns_all_rows(spark, many_partitions):
    """A single feature, then very many entities of its key: it is carried over all partitions."""
    entities = spark.range(5_000).selectExpr("id AS i", "cast(null AS STRING) AS `a.b`", "7 AS k", "'x' AS l", "timestamp_seconds(100 + id) AS t")
    features = spark.sql("SELECT 7 AS k, 'x' AS l, timestamp_seconds(50) AS t, 1.5 AS v UNION ALL SELECT 7, 'x', timestamp_seconds(4000), 2.5 UNION ALL SELECT 7, 'y', timestamp_seconds(60), 9.5")
    got = J.asof_join(entities, features, ["k", "l"], ["v"], 10**12, "t", "t")
    plan = got._jdf.queryExecution().toString()
    assert plan.count("Exchange") <= 6 and "SortAggregate" not in plan
    assert got.columns == ["i", "a.b", "k", "l", "t", "v", "feature_timestamp"]
    assert {(r["i"], float(r["v"])) for r in got.collect()} == {(i, 1.5 if i < 3900 else 2.5) for i in range(5_000)}
    assert J.asof_join(entities.limit(0), features, ["k", "l"], ["v"], 1, "t", "t").count() == 0
    assert {r["v"] for r in J.asof_join(entities.limit(9), features.limit(0), ["k", "l"], ["v"], 1, "t", "t").collect()} == {None}


def test_latest_row_without_sorting_rows(rows):
    df = rows("k STRING, t BIGINT, u BIGINT, v STRING", ("a", 1, 1, "x"), ("a", 2, 1, "y"), ("a", 2, 3, "z"), ("a", 2, 3, "z"), ("b", None, 1, "n"), (None, 5, 1, "q"), (None, 4, 9, "r"))
    got = W.latest_per_key(df, ["k"], ["t", "u"])
    assert "SortAggregate" not in got._jdf.queryExecution().toString()
    assert {(r["k"], r["v"]) for r in got.collect()} == {("a", "z"), ("b", "n"), (None, "q")} and got.count() == 3


def test_asof_equal_time_and_expiry(rows):
    t = datetime(2024, 1, 1)
    features = rows("k BIGINT, t TIMESTAMP, v DOUBLE", (1, t, 1.0), (2, t - timedelta(days=2), 2.0))
    entities = rows("k BIGINT, t TIMESTAMP", (1, t), (2, t))
    got = J.asof_join(entities, features, ["k"], ["v"], 86_400_000_000, "t", "t")
    assert sorted((r["k"], r["v"]) for r in got.collect()) == [(1, 1.0), (2, None)]


# --- quality gate ---------------------------------------------------------


def test_gate(rows):
    schema = "user_id BIGINT, product_id BIGINT, event_type STRING, timestamp BIGINT, duration_seconds BIGINT"
    good = rows(schema, (1, 2, "view", 10, 5))
    results = Q.gate({"user_interactions": good})
    assert results.count() == 9
    for bad in ((None, 2, "view", 10, 5), (1, 2, "error", 10, 5), (1, 2, "view", 10, -5)):
        with pytest.raises(Q.QualityGateError, match="failed on"):
            Q.gate({"user_interactions": rows(schema, bad)})
    with pytest.raises(Q.QualityGateError, match="empty"):
        Q.gate({"user_interactions": good.limit(0)})
    # lenient mode reads a null id as 0
    Q.gate({"user_interactions": rows(schema, (None, 2, "view", 10, 5))}, coerce_first=True)
