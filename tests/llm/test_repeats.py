from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from marketloom.llm import repeats
from .helpers import ODD, by_id


def brute(rows):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i : i + 200] for b in data for i in range(len(b) - 199))
    out = []
    for (doc_id, _), b in zip(rows, data):
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(b) else 0
        out.append((doc_id, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def fixture():
    rnd = random.Random(3)
    passage = "".join(rnd.choice("abcdefgh éß") for _ in range(700))
    rows = list(ODD)
    for i in range(30):
        a, b = sorted(rnd.sample(range(700), 2))
        around = ["".join(rnd.choice("xyz ") for _ in range(rnd.randint(0, 250))) for _ in range(2)]
        rows.append((100 + i, around[0] + passage[a:b] + around[1]))
    rows += [(50, "a" * 600), (51, "ab" * 250), (52, "\0" * 350), (53, passage[:200] + "q"), (54, passage[:199] + "Q"), (55, rows[10][1]), (None, passage[100:400])]
    return rows


@pytest.mark.parametrize(("hot", "piece"), [(4000, 1 << 19), (3, 700)])
def test_against_brute_force(docs, monkeypatch, hot, piece):
    monkeypatch.setattr(repeats, "HOT_CONTEXTS", hot)
    monkeypatch.setattr(repeats, "PIECE_BYTES", piece)
    rows = fixture()
    monkeypatch.setattr(repeats, "table", lambda *_: docs(*rows))
    got = repeats.op7_suffix_array(docs().sparkSession, "")
    assert by_id(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute(rows)


def test_empty_table(docs):
    assert repeats.without_repeats(docs()).count() == 0


def test_maximal_repeats():
    rnd = random.Random(1)
    data = np.frombuffer("".join(rnd.choice("ab") for _ in range(400)).encode() + b"#" + b"abc" * 200, np.uint8)
    starts, ends = np.arange(len(data)), np.full(len(data), len(data))
    text = bytes(data)
    for length, places in repeats.maximal_repeats(data, starts, ends, 10):
        own = {text[i : i + length] for i in places.tolist()}
        assert len(own) == 1
        found = own.pop()
        every = [i for i in range(len(text) - length + 1) if text.startswith(found, i)]
        assert sorted(places.tolist()) == every
        assert len({text[i - 1 : i] if i else None for i in every}) > 1 or 0 in every
