"""Recommenders and metrics against numpy and brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.operators import scoring
from marketloom.plans import content, evaluate, svd


def long_matrix(rows, dense):
    cells = [(int(u), int(i), float(dense[u, i])) for u, i in zip(*np.nonzero(dense))]
    return rows("user_id BIGINT, product_id BIGINT, implicit_score DOUBLE", *cells)


def factors(df, key):
    local = df.orderBy(key).toPandas()
    return local[key].to_numpy(), np.vstack(local["factors"].to_numpy())


@pytest.mark.parametrize("method", ["tiled", "joined"])
def test_svd_of_low_rank_matrix_is_exact(spark, rows, method):
    rng = np.random.default_rng(3)
    dense = rng.integers(0, 4, (30, 4)) @ rng.integers(0, 3, (4, 12)).astype(float)
    model = svd.fit(long_matrix(rows, dense), components=6, oversample=4, method=method)
    users, u = factors(model.user_factors, "user_id")
    items, v = factors(model.item_factors, "product_id")
    assert np.allclose(u @ v.T, dense[np.ix_(users, items)], atol=1e-8)
    exact = np.linalg.svd(dense, compute_uv=False)[: np.linalg.matrix_rank(dense)][:6]
    assert np.allclose(model.singular_values, exact, rtol=1e-8)
    assert abs(svd.explained_variance(model).first()[0] - 1.0) < 1e-8


@pytest.mark.parametrize("method", ["tiled", "joined"])
def test_truncated_svd_matches_numpy(spark, rows, method):
    rng = np.random.default_rng(5)
    # a decaying spectrum, so that the leading subspace is well defined
    left, _ = np.linalg.qr(rng.normal(size=(40, 15)))
    right, _ = np.linalg.qr(rng.normal(size=(15, 15)))
    dense = left @ np.diag(0.5 ** np.arange(15) * 100) @ right.T
    cells = [(int(a), int(b), float(dense[a, b])) for a in range(40) for b in range(15)]
    train = rows("user_id BIGINT, product_id BIGINT, implicit_score DOUBLE", *cells)
    model = svd.fit(train, components=4, oversample=6, method=method)
    _, u = factors(model.user_factors, "user_id")
    _, v = factors(model.item_factors, "product_id")
    uu, s, vt = np.linalg.svd(dense, full_matrices=False)
    best = uu[:, :4] @ np.diag(s[:4]) @ vt[:4]
    assert np.allclose(u @ v.T, best, atol=1e-6)
    kept = (uu[:, :4] * s[:4]).var(axis=0).sum() / dense.var(axis=0).sum()
    assert abs(svd.explained_variance(model).first()[0] - kept) < 1e-8


def subspace_iteration(dense, components=50, oversample=10, steps=5):
    """Singular values of the plain randomised method."""
    rng = np.random.default_rng(1)
    q = rng.normal(size=(dense.shape[1], components + oversample))
    for _ in range(steps):
        q, _ = np.linalg.qr(dense.T @ np.linalg.qr(dense @ q)[0])
    return np.linalg.svd(dense @ q, compute_uv=False)[:components]


def test_rank_50_of_a_flat_spectrum(spark, rows, monkeypatch):
    """Random counts over several blocks of users and items: neighbouring singular values are close."""
    monkeypatch.setattr(svd, "ITEM_BLOCK", 100)
    monkeypatch.setattr(svd, "USER_BLOCKS", (150, 150))
    monkeypatch.setattr(svd, "TASK_ENTRIES", 4000)
    dense = np.random.default_rng(9).poisson(0.2, size=(900, 600)).astype(float)
    dense[:, 0] += 3.0  # a product that everybody has
    train = long_matrix(rows, dense)
    exact = np.linalg.svd(dense, compute_uv=False)
    model = svd.fit(train)
    # the default steps keep as much of the matrix as five plain iterations
    kept, plain = np.square(model.singular_values).sum(), np.square(subspace_iteration(dense)).sum()
    assert kept > 0.9999 * plain and kept > 0.98 * (exact[:50] ** 2).sum() and 0 < model.residual < 0.1
    users, u = factors(model.user_factors, "user_id")
    items, v = factors(model.item_factors, "product_id")
    assert np.allclose(v.T @ v, np.eye(50), atol=1e-10) and np.allclose(u, dense[np.ix_(users, items)] @ v, atol=1e-8)
    better = svd.fit(train, steps=12, tolerance=1e-9)
    assert np.allclose(better.singular_values, exact[:50], rtol=1e-9) and better.residual <= 1e-9


def test_rank_50_of_a_decaying_spectrum(spark, rows):
    rng = np.random.default_rng(4)
    left, _ = np.linalg.qr(rng.normal(size=(300, 120)))
    right, _ = np.linalg.qr(rng.normal(size=(120, 120)))
    dense = left @ np.diag(0.8 ** np.arange(120)) @ right.T
    cells = [(f"u{a}", f"i{b}", float(dense[a, b])) for a in range(300) for b in range(120)]
    train = rows("user_id STRING, product_id STRING, implicit_score DOUBLE", *cells)
    exact = np.linalg.svd(dense, compute_uv=False)[:50]
    assert np.allclose(svd.fit(train).singular_values, exact, rtol=1e-6)
    assert np.allclose(subspace_iteration(dense), exact, rtol=1e-3)


def test_nothing_on_the_driver_grows_with_items(spark, rows, monkeypatch):
    """What a fit brings to the driver has at most as many rows as the basis has columns."""
    seen = []
    merged = svd._merged
    monkeypatch.setattr(svd, "_merged", lambda *args: seen.append(merged(*args)) or seen[-1])
    monkeypatch.setattr(svd, "ITEM_BLOCK", 64)
    dense = np.random.default_rng(2).poisson(0.3, size=(80, 500)).astype(float)
    svd.fit(long_matrix(rows, dense), components=3, oversample=2, steps=3)
    assert seen and max(max(x.shape) for x in seen) <= 5 * 4


def test_no_quiet_end(spark, rows, monkeypatch):
    dense = np.random.default_rng(9).poisson(0.4, size=(60, 40)).astype(float)
    monkeypatch.setattr(svd, "STEPS_JOINED", 1)
    for options in ({"steps": 1, "tolerance": 1e-9}, {"method": "joined"}):
        with pytest.raises(RuntimeError, match="converged"):
            svd.fit(long_matrix(rows, dense), components=3, oversample=2, **options)
    with pytest.raises(ValueError, match="empty"):
        svd.fit(long_matrix(rows, np.zeros((2, 2))))


@pytest.mark.parametrize("widths", [svd.WIDTHS_JOINED, 3])
def test_joined_multiplies_few_times_in_a_flat_spectrum(spark, rows, monkeypatch, widths):
    """Plain steps would take dozens; a basis that starts again in between finds the same."""
    monkeypatch.setattr(svd, "WIDTHS_JOINED", widths)
    calls, multiply = [], svd._multiply
    monkeypatch.setattr(svd, "_multiply", lambda *a: calls.append(a[-1]) or multiply(*a))
    dense = np.random.default_rng(13).random((150, 60))
    model = svd.fit(long_matrix(rows, dense), components=2, oversample=8, method="joined")
    left, exact, right = np.linalg.svd(dense, full_matrices=False)
    users, u = factors(model.user_factors, "user_id")
    items, v = factors(model.item_factors, "product_id")
    best = (left[:, :2] * exact[:2]) @ right[:2]
    assert np.allclose(model.singular_values, exact[:2], rtol=1e-9) and np.allclose(u @ v.T, best[np.ix_(users, items)], atol=1e-5)
    assert len(calls) < 40 and max(calls) <= 10


def test_svd_predict_recommend_and_errors(spark, rows):
    rng = np.random.default_rng(11)
    dense = rng.integers(0, 3, (12, 9)).astype(float)
    dense[:, 0] = 1
    dense[0, :] = 1
    train = long_matrix(rows, dense)
    model = svd.fit(train, components=3, oversample=6)
    users, u = factors(model.user_factors, "user_id")
    items, v = factors(model.item_factors, "product_id")
    scores = dict(zip(((int(a), int(b)) for a in users for b in items), (u @ v.T).ravel()))
    pairs = rows("user_id BIGINT, product_id BIGINT", (1, 2), (1, 999), (999, 2))
    got = {(r["user_id"], r["product_id"]): r["prediction"] for r in svd.predict(model, pairs).collect()}
    assert got[1, 999] == got[999, 2] == 0.0 and abs(got[1, 2] - scores[1, 2]) < 1e-9
    recs = svd.recommend(model, 4).collect()
    for user in range(12):
        open_items = [i for i in range(9) if dense[user, i] == 0]
        best = sorted(open_items, key=lambda i: (-round(scores[user, i], 9), i))[:4]
        assert [r["product_id"] for r in sorted(recs, key=lambda r: r["rank"]) if r["user_id"] == user] == best
    actual = np.array([1.0, 2.0, 0.5])
    test = rows("user_id BIGINT, product_id BIGINT, implicit_score DOUBLE", (1, 2, 1.0), (1, 999, 2.0), (3, 4, 0.5))
    predicted = np.array([scores[1, 2], 0.0, scores[3, 4]])
    row = svd.prediction_error(model, test).first()
    error = actual - predicted
    assert abs(row["rmse"] - np.sqrt((error**2).mean())) < 1e-9
    assert abs(row["mae"] - np.abs(error).mean()) < 1e-9
    assert abs(row["r2"] - (1 - (error**2).sum() / ((actual - actual.mean()) ** 2).sum())) < 1e-9


@pytest.mark.parametrize("chunk_cells", [40, 1_000_000])
@pytest.mark.parametrize("cosine", [True, False])
@pytest.mark.parametrize("dense", [True, False])
def test_recommend_matches_brute_force(spark, rows, monkeypatch, dense, cosine, chunk_cells):
    if not dense:
        monkeypatch.setattr(scoring, "CHUNK_CELLS", 0)
    rng = random.Random(2)
    dims = [f"d{j}" for j in range(6)]

    def vectors(n, key):
        # few distinct values, so that score ties are common; item 0 is all zero
        cells = [(k, d, float(rng.randint(0, 2)) if k else 0.0) for k in range(n) for d in dims]
        return cells, rows(f"{key} BIGINT, dim STRING, value DOUBLE", *cells)

    user_cells, users = vectors(8, "user_id")
    item_cells, items = vectors(25, "product_id")
    # user 1 has seen nearly everything
    seen = [(1, i) for i in range(22)] + [(u, rng.randint(0, 24)) for u in range(2, 8) for _ in range(5)]
    seen_df = rows("user_id BIGINT, product_id BIGINT", *seen).distinct()
    recs = scoring.recommend(
        scoring.pack_vectors(users, "user_id"), scoring.pack_vectors(items, "product_id"), seen_df, 5,
        cosine=cosine, chunk_cells=chunk_cells,
    ).collect()

    def vector(cells, key):
        return np.array([v for k, _, v in cells if k == key])

    def score(u, i):
        a, b = vector(user_cells, u), vector(item_cells, i)
        scale = np.linalg.norm(a) * np.linalg.norm(b) if cosine else 1.0
        return round(float(a @ b / scale), 9) if scale > 0 else 0.0

    for u in range(8):
        open_items = [i for i in range(25) if (u, i) not in seen]
        best = sorted(open_items, key=lambda i: (-score(u, i), i))[:5]
        got = sorted((r["rank"], r["product_id"]) for r in recs if r["user_id"] == u)
        assert [i for _, i in got] == best
    summary = scoring.score_summary(
        scoring.pack_vectors(users, "user_id"), scoring.pack_vectors(items, "product_id"), cosine=cosine, chunk_cells=chunk_cells
    ).collect()
    for r in summary:
        everything = [score(r["user_id"], i) for i in range(25)]
        assert r["n_items"] == 25
        assert abs(r["best_score"] - max(everything)) < 1e-8 and abs(r["mean_score"] - np.mean(everything)) < 1e-8


def test_profiles_ignore_weightless_users_and_unknown_items(rows):
    vectors = rows("product_id BIGINT, dim STRING, value DOUBLE", (1, "a", 1.0), (2, "a", 3.0))
    seen = rows(
        "user_id BIGINT, product_id BIGINT, implicit_score DOUBLE",
        (1, 1, 1.0), (1, 2, 2.0), (1, 2, 1.0), (1, 77, 50.0), (2, 1, 0.0), (3, 77, 4.0),
    )
    got = content.user_profiles(vectors, seen).collect()
    assert [(r["user_id"], r["value"]) for r in got] == [(1, 2.5)]


def test_ranking_metrics(rows):
    pair = "user_id BIGINT, product_id BIGINT"
    recs = rows(pair, (1, 10), (1, 11), (2, 10))
    test = rows(pair, (1, 10), (1, 12), (1, 10), (2, 13), (9, 10))
    known = rows("user_id BIGINT", (1,), (2,))
    row = evaluate.ranking_metrics(recs, test, known, 5).first()
    assert (row["evaluated_users"], row["precision_at_n"], row["recall_at_n"], row["hit_rate_at_n"]) == (2, 0.1, 0.25, 0.5)
    none = evaluate.ranking_metrics(recs, test, known.limit(0), 5).first()
    assert (none["evaluated_users"], none["precision_at_n"]) == (0, 0.0)


def test_split_is_repeatable_and_near_the_share(spark):
    df = spark.range(20_000).select(F.col("id").alias("user_id"), (F.col("id") % 7).alias("product_id"))
    train, test = evaluate.split(df, "user_id", "product_id")
    n = test.count()
    assert n + train.count() == 20_000 and abs(n / 20_000 - 0.3) < 0.02


def test_chunks_are_pruned_and_read_in_one_job(spark, rows):
    """Items of falling length: equal results for one chunk and for forty, and far fewer chunks than pairs."""
    rng = np.random.default_rng(8)
    v = rng.normal(size=(400, 6)) * (0.97 ** np.arange(400))[:, None]
    u = rng.normal(size=(30, 6))
    packed = lambda x, key: rows(f"{key} BIGINT, dims ARRAY<INT>, vals ARRAY<DOUBLE>, norm DOUBLE", *[(i, list(range(6)), [float(a) for a in r], float(np.linalg.norm(r))) for i, r in enumerate(x)])
    users, items = packed(u, "user_id"), packed(v, "product_id")
    seen = rows("user_id BIGINT, product_id BIGINT", *[(i, j) for i in range(30) for j in range(i % 5)])
    found, jobs = {}, {}
    for name, cells in (("one", 10_000), ("forty", 60)):
        recs = scoring.recommend(users, items, seen, 5, chunk_cells=cells, with_chunks=True)
        group = f"scoring-{name}"
        spark.sparkContext.setJobGroup(group, name)
        found[name] = recs.collect()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        jobs[name] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    plain = lambda rs: sorted((r["user_id"], r["rank"], r["product_id"], r["score"]) for r in rs)
    assert plain(found["one"]) == plain(found["forty"]) and jobs["one"] == jobs["forty"]
    assert {r["chunks_read"] for r in found["one"]} == {1}
    read = {r["user_id"]: r["chunks_read"] for r in found["forty"]}
    assert len(read) == 30 and max(read.values()) < 40 and sum(read.values()) < 0.5 * 30 * 40
    for i in range(30):
        best = sorted((j for j in range(i % 5, 400)), key=lambda j: (-round(float(u[i] @ v[j]), 9), j))[:5]
        assert [r["product_id"] for r in sorted(found["forty"], key=lambda r: r["rank"]) if r["user_id"] == i] == best
