from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from marketloom.llm import periodic

from .conftest import SF
from .helpers import ODD


def plain_runs(words, least=6, exponent=4):
    """All runs, from every period by itself."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    marks = np.array([number[w] for w in words])
    n, out = len(words), []
    for q in range(1, n // exponent + 1):
        same = np.flatnonzero(np.diff(np.r_[0, marks[q:] == marks[:-q], 0]))
        out += [(int(i), int(j - i) + q, q) for i, j in same.reshape(-1, 2) if j - i + q >= max(least, exponent * q)]
    found = set(out)
    # a stretch of a smaller period is that period's
    return sorted((s, m, q) for s, m, q in found if not any(p < q and a <= s and s + m <= a + k for a, k, p in found))


def plain_text(doc_id, text):
    words = text.encode().split()
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    return words


def plain_row(doc_id, text):
    words = plain_text(doc_id, text)
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    mark = hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in sorted(runs, key=lambda r: (r[0], r[2]))).encode()).hexdigest()
    return (doc_id, len(runs), *told, mark, hashlib.sha256(kept).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_runs_of_random_words(letters):
    rng = random.Random(letters)
    for _ in range(150):
        words = []
        while len(words) < 120:
            piece = [rng.randrange(letters) for _ in range(rng.randrange(1, 14))]
            words += piece * rng.choice([1, 1, 4, 5, 9]) + piece[: rng.randrange(len(piece) + 1)]
        assert periodic.runs_of(np.array(words)) == sorted(plain_runs(words), key=lambda r: (r[0], r[2]))


def test_long_periods_and_highly_periodic_words():
    rng = random.Random(9)
    for q in (1, 2, 31, 32, 33, 500):
        root = [rng.randrange(4) for _ in range(q)]
        words = [7, 8, *(root * 5)[: 4 * q + q // 2], 9]
        assert periodic.runs_of(np.array(words)) == sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    fib = [0], [0, 1]
    while len(fib[1]) < 900:
        fib = fib[1], fib[1] + fib[0]
    assert periodic.runs_of(np.array(fib[1])) == plain_runs(fib[1])
    assert periodic.runs_of(np.zeros(20_000, int)) == [(0, 20_000, 1)]
    assert periodic.runs_of(np.zeros(5, int)) == [] and periodic.runs_of(np.zeros(0, int)) == []


def test_range_successor():
    rng = np.random.default_rng(5)
    values = rng.permutation(300)
    tree = periodic.WaveletTree(values)
    low = rng.integers(0, 300, 500)
    high = low + rng.integers(0, 301 - low)
    above = rng.integers(-1, 700, 500)
    plain = [min((v for v in values[a:b] if v > x), default=-1) for a, b, x in zip(low, high, above)]
    assert tree.successor(low, high, above).tolist() == plain


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in periodic.op12_periodic_runs(spark, SF).collect()}
    assert got == {d.doc_id: plain_row(d.doc_id, d.text or "") for d in docs}
    assert any(r[1] for r in got.values())


def test_odd_documents(spark, docs, monkeypatch):
    planted = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    rows = [*ODD, (8, "a " * 60_000), (9, "b c d " * 30 + "tail"), (11, "\x0b".join("xyxyxyxyxy")), *((i, " ".join(map(str, range(40)))) for i in planted)]
    monkeypatch.setattr(periodic, "table", lambda *_: docs(*rows))
    got = periodic.op12_periodic_runs(spark, "").select(COLUMNS).collect()
    expected = [plain_row(i, t or "") if i not in (8, None) else None for i, t in rows]
    assert sorted(map(str, (tuple(r) for r in got if r.doc_id not in (8, None)))) == sorted(str(e) for e in expected if e)
    long = next(r for r in got if r.doc_id == 8)
    assert (long.n_runs, long.start, long.length, long.period, long.exponent_milli) == (1, 0, 60_000, 1, 60_000_000)
    assert next(r for r in got if r.doc_id is None).n_runs == 0
    monkeypatch.setattr(periodic, "table", lambda *_: docs())
    assert periodic.op12_periodic_runs(spark, "").count() == 0


def test_general_results(spark, docs):
    out = periodic.find_runs(docs((1, "say a b a b a b a b a now")), min_words=6, min_exponent=4).first()
    assert [tuple(r) for r in out.runs] == [(1, 9, 2)] and out.collapsed == "say a b now"
    with pytest.raises(ValueError):
        periodic.find_runs(docs(), min_exponent=3)
