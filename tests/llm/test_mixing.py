from __future__ import annotations

import re

from pyspark.sql import functions as F

from marketloom.llm import mixing
from .helpers import ODD


def targets(sizes: dict, weights=(3, 1, 2), share=1.5, cap=2.0) -> dict:
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, held = share * sum(sizes.values()), {}
    while len(held) < len(names):
        free = [s for s in names if s not in held]
        level = (total - sum(held.values())) / sum(weight[s] for s in free)
        above = [s for s in free if weight[s] * level > cap * sizes[s]]
        if not above:
            return held | {s: weight[s] * level for s in free}
        held |= {s: cap * sizes[s] for s in above}
    return held


def many(n=600):
    sources = ["b", "a", "Z", "é", "", None, "d"]
    return [(i, "w " * (i * 7919 % 23), sources[i % 7] if i % 3 else "hot") for i in range(n)]


def check(rows, frame, **options):
    got = mixing.mix(frame, mixing.words(F.coalesce("text", F.lit(""))), **options).collect()
    assert len(got) == len(rows)
    size, taken = {}, {}
    for r in got:
        assert r["__mix_size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert 0 <= r["__mix_taken"] <= 2 * r["__mix_size"]
        size[r.source] = size.get(r.source, 0) + r["__mix_size"]
        taken[r.source] = taken.get(r.source, 0) + r["__mix_taken"]
    expected = targets(size)
    for r in got:
        assert r["__mix_source_size"] == size[r.source]
        assert abs(r["__mix_target"] - expected[r.source]) < 1e-6
    for source, words in taken.items():
        assert abs(words - expected[source]) <= 1
    return got


def test_quotas_are_met_whatever_the_shards(docs):
    rows = many()
    for shard_words in (10_000_000, 500, 3):
        got = check(rows, docs(*rows), shard_words=shard_words)
    assert len({r["__mix_shard"] for r in got}) > 16


def test_odd_rows_and_reruns(docs):
    rows = [*((i, t, None if i is None else f"s{i}") for i, t in ODD), (8, "a b c", None)]
    frame = docs(*rows)
    again = docs(*rows, parts=1)
    first, second = (sorted((str(r.doc_id), r["__mix_taken"]) for r in check(rows, f)) for f in (frame, again))
    assert first == second
    assert mixing.mix(docs(), F.lit(1).cast("bigint")).count() == 0


def test_splits_stay_inside_both_halves(spark):
    held = [(n, s, (n * 31 + s * 17) % 9) for n in range(5) for s in range(16)]
    quotas = [(n, sum(h for m, _, h in held if m == n) * n // 4) for n in range(5)]
    out = mixing.split_quotas(spark.createDataFrame(quotas, "number bigint, quota bigint"), spark.createDataFrame(held, "number bigint, shard bigint, held bigint"), 4)
    got = {(r.number, r.shard): r.quota for r in out.collect()}
    assert all(got.get((n, s), 0) <= h for n, s, h in held)
    assert all(sum(q for (m, _), q in got.items() if m == n) == quota for n, quota in quotas)


def test_mixed_documents(docs):
    rows = many(200)
    frame = docs(*rows)
    out = mixing.mixed_documents(frame)
    assert out.columns == frame.columns
    texts = dict((i, t) for i, t, _ in rows)
    words, longest = {}, {}
    for r in out.collect():
        # whole texts only, however close to the target a part would come
        assert r.text == texts[r.doc_id] and r["a.b"] == r["__mix_part"] == 7
        words[r.source] = words.get(r.source, 0) + len((r.text or "").split())
    for _, t, s in rows:
        longest[s] = max(longest.get(s, 0), len((t or "").split()))
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    assert all(abs(words.get(s, 0) - t) <= longest[s] / 2 + 1 for s, t in targets(sizes).items())


def test_rows_without_ids_are_told_apart_by_their_texts(docs):
    frame = docs(*((None, f"some words {i}", "s") for i in range(60)))
    first, again = (sorted(r.text for r in mixing.mixed_documents(x).collect()) for x in (frame, frame.repartition(7)))
    assert first == again and len(set(first)) > 30


def test_main_path_has_no_python(spark):
    plan = mixing.op6_mixing(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "MapInArrow"))
