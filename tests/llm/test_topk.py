from __future__ import annotations

import math
import random

import numpy as np
import pytest

from marketloom.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>, label int, score string, v int"


def brute(rows, k):
    fine = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in {i: v for i, v in fine if i % 50 == 0}.items():
        best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in fine if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def rows(n, width=6, scale=1.0):
    rnd = random.Random(7)
    return [(i, [rnd.gauss(0, 1) * scale for _ in range(width)], 1, "x", 2) for i in range(n)]


ODD = [(1000, None, 1, "x", 2), (1050, [1.0, None], 1, "x", 2), (1100, [float("nan")] * 3, 1, "x", 2), (1150, [float("inf"), 1.0], 1, "x", 2), (None, [1.0] * 6, 1, "x", 2), (1200, [0.5, 0.25], 1, "x", 2), (1250, [], 1, "x", 2)]


@pytest.mark.parametrize(("shard", "block", "n"), [(8192, 512, 400), (60, 3, 400), (60, 512, 4), (8192, 512, 0)])
def test_against_brute_force(spark, monkeypatch, shard, block, n):
    monkeypatch.setattr(topk.search, "__defaults__", (5, shard, block))
    monkeypatch.setattr(topk, "LEAF_ROWS", 16)
    given = rows(n) + ([(700 + i, [1.0] * 6, 1, "x", 2) for i in range(30)] if n > 100 else []) + (ODD if n else [])
    monkeypatch.setattr(topk, "table", lambda *_: spark.createDataFrame(given, SCHEMA).repartition(3))
    got = topk.op1_kd_tree(spark, "")
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == brute(given, 5)


def test_large_components_stay_exact():
    a = np.array([[2**40, -(2**40)], [2**20, 1]])
    assert topk.products(a, a).tolist() == [[2**63 - 1, 2**60 - 2**40], [2**60 - 2**40, 2**40 + 1]]
    assert topk.products(np.array([[2**26, 3]]), np.array([[2**26, 5]])).tolist() == [[2**52 + 15]]


def test_tree_visits_only_boxes_that_can_win():
    rnd = np.random.Generator(np.random.PCG64(3))
    centres = rnd.integers(-2000, 2000, (40, 3))
    vectors = (centres[:, None] + rnd.integers(-3, 4, (40, 50, 3))).reshape(-1, 3)
    tree = topk.Tree(vectors, np.arange(len(vectors)), 16)
    query, seen = np.array([900, 40, -300]), []
    for node, rows_ in enumerate(tree.rows):
        if rows_ is not None:
            tree.rows[node] = Watched(rows_, seen)
    found = tree.search(query, -1, tree.bounds(query[None])[0], 5, topk.LEAST)
    scores = vectors @ query
    assert found == [(int(scores[i]), int(i)) for i in sorted(range(len(scores)), key=lambda i: (-scores[i], i))[:5]]
    assert len(seen) < sum(r is not None for r in tree.rows) / 4


class Watched(np.ndarray):
    def __new__(cls, rows_, seen):
        own = np.asarray(rows_).view(cls)
        own.seen = seen
        return own

    def __array_finalize__(self, other):
        self.seen = getattr(other, "seen", None)

    def __getitem__(self, i):
        return int(np.asarray(self)[i])

    def __index__(self):
        raise TypeError
