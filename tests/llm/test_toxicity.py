from __future__ import annotations

import random
import zlib

import pytest

from marketloom.llm import toxicity
from .helpers import ODD

BAD, GOOD = ["idiot", "moron", "scum", "stupid"], ["the", "of", "and", "reading", "tion", "house", "water", "morning", "scarlet", "study"]


def corpus(n=900):
    rnd = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        words = [rnd.choice(GOOD) + rnd.choice(["", "s", "ly"]) for _ in range(30)]
        toxic = int(i % 4 == 0)
        if toxic:
            for _ in range(3):
                words[rnd.randrange(30)] = rnd.choice(BAD)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return rows, labels


@pytest.fixture(scope="module")
def labelled(spark):
    rows, labels = corpus()
    return rows, spark.createDataFrame(labels + [(None, 1, 1), (1, 0, None), (0, 1, 0)], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def model(spark, labelled):
    docs = spark.createDataFrame(labelled[0], "doc_id bigint, text string").repartition(3)
    return toxicity.fit(docs, labelled[1])


def test_readings(model):
    read = model.restorer.word
    for told, meant in {"1d10t": "idiot", "m0r0n": "moron", "$cum": "scum", "5tup1d": "stupid", "s.t.u.p.i.d": "stupid", "s t u p i d": "stupid", "stuuuupid": "stupid", "house": "house"}.items():
        assert read(told) == meant
    assert model.restorer.restored("A m0r0n, the house of 127.0.0.1!") == "a moron the house of 127.0.0.1!"


def test_scores(model):
    assert all(model.score(f"the house {w} of water") >= 0.7 for w in ["moron", "M0R0N", "$cum", "i d i o t", "stuuuupid!"])
    assert all(model.score(t) < 0.3 for t in ["the house of water", "morning study", "", None, "scarlet 1000 $5.00"])
    assert model.score("moron " * 20_000) >= 0.7


def test_letters_apart(model):
    told = ["an i d i o t.", "m o r o n, the", "the s c u m!", "s c u m !", "the m.o r-o n", "i  d  i  o  t", "i\nd\ni\no\nt", "s t u p i d; of"]
    told += ["t h e  h o u s e  o f  s c u m", "w a t e r  i d i o t  o f", "m o r o n\nw a t e r", "t h e  m o r o n, w a t e r"]
    assert {t: model.score(f"the house of water {t}") >= 0.7 for t in told} == dict.fromkeys(told, True)
    clean = ["t h e  h o u s e.", "s t u d y, the", "a b c, of water", "u.s.a. the house", "a a a a a.", "! ! !"]
    assert {t: model.score(f"the house of water {t}") < 0.3 for t in clean} == dict.fromkeys(clean, True)


def test_sign_of_letters_apart():
    rnd = random.Random(5)
    for _ in range(20_000):
        text = "".join(rnd.choice("ab1é!$|_ .-*,\n") for _ in range(rnd.randint(0, 14)))
        assert toxicity.APART_SIGN.search(text) or not toxicity.APART.search(text)


def test_held_out_rows_do_not_teach(spark, docs, labelled):
    rows, labels = labelled
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    flipped = labels.rdd.map(lambda r: (r[0], r[1], None if r[2] is None else (1 - r[2] if r[0] in held else r[2])))
    other = toxicity.fit(frame, spark.createDataFrame(flipped, labels.schema))
    assert other.weights == toxicity.fit(frame, labels).weights


def test_rows(docs, labelled, monkeypatch):
    rows = [*labelled[0], *ODD]
    tables = {"documents": docs(*rows), "labels": labelled[1]}
    monkeypatch.setattr(toxicity, "table", lambda _, __, name: tables[name])
    out = toxicity.op2_toxicity(docs().sparkSession, "").collect()
    assert len(out) == len(rows)
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    toxic = {i for i, t in rows if any(w in (t or "").split() for w in BAD)}
    assert {r.doc_id for r in out if r.predicted} == toxic
    kept = toxicity.keep_clean(tables["documents"], labelled[1])
    assert kept.columns == tables["documents"].columns and kept.count() == len(rows) - len(toxic)


def test_without_labels(docs, labelled):
    labels = labelled[1].limit(0)
    assert toxicity.keep_clean(docs(*ODD), labels).count() == len(ODD)
    assert toxicity.keep_clean(docs(), labels).count() == 0
