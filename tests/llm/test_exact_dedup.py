from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest

from marketloom.llm import exact_dedup
from .helpers import ODD, by_id


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((i, len(t or "")))
    out = []
    for norm, own in groups.items():
        keep = min(own, key=lambda r: (-r[1], r[0] is None, r[0] or 0))[0]
        out += [(i, keep, len(own), hashlib.sha256(norm.encode()).hexdigest()) for i, _ in own]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("block", [3, 8192])
def test_against_brute_force(docs, block, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BLOCK_BYTES", block)
    monkeypatch.setattr(exact_dedup.identities, "__defaults__", ("doc_id", "text", block))
    rnd = random.Random(2)
    rows = list(ODD) + [(10 + i, "".join(rnd.choice("ab ") for _ in range(rnd.randint(0, 9)))) for i in range(150)]
    rows += [(500 + i, "hot text" + " " * (i % 3)) for i in range(120)]
    found = exact_dedup.digest(docs(*rows))
    assert by_id(found, "doc_id", "keep_id", "group_size", "text_sha256") == brute(rows)
    kept = found.where("kept").collect()
    assert len(kept) == len({r[3] for r in brute(rows)})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_documents_that_stay(docs):
    rows = [*ODD, (20, "a b"), (21, "ab"), (22, "a  b"), (23, "a  b")]
    frame = docs(*rows)
    got = exact_dedup.keep_first(frame)
    assert got.columns == frame.columns
    assert by_id(got, "doc_id", "text") == by_id(docs((3, " \t\n"), (None, "no id here at all"), (4, "twice the same row"), ODD[-1], (22, "a  b")), "doc_id", "text")
    assert exact_dedup.keep_first(docs()).count() == exact_dedup.digest(docs()).count() == 0


def test_columns_of_any_name_stay(docs):
    frame = docs((1, "a b"), (1, "ab"), (1, "a  b"), (2, "c"))
    out = exact_dedup.keep_first(frame).collect()
    assert sorted((r.doc_id, r.text) for r in out) == [(1, "a  b"), (2, "c")] and all(r["__id"] == r["__n"] == r["a.b"] == 7 for r in out)
    tie = docs((5, "x y"), (5, " xy"), (5, "xy "))
    assert len({exact_dedup.keep_first(tie.repartition(n)).first().text for n in (1, 2, 5)}) == 1
