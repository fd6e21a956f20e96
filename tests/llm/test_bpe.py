from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marketloom.llm import bpe
from .helpers import ODD, by_id

PARTS = ["a", "b", "the", " ", "  ", "\n", "'s", "'", "'re", "1", "23", "é", "日", "!", "...", "\t", "\x1c", "😀", "　"]


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=60), st.integers(2, 9))
def test_joins_are_exact(codec, parts, leaf):
    text, before = "".join(parts), bpe.LEAF_CHARS
    bpe.LEAF_CHARS = leaf
    try:
        ids = codec.encode(text)
    finally:
        bpe.LEAF_CHARS = before
    assert ids == codec.library.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 30_000, " " * 70_000 + "x", "x" + " " * 70_000, "\n" * 70_000 + "y", "*" * 20_000, "ab " * 20_000])
def test_long_runs(codec, text):
    ids = codec.encode(text)
    assert ids == codec.library.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


def test_white_space_that_the_library_cannot_match(codec):
    ids = codec.encode("x" + " " * 1_500_000 + "y")
    assert codec.decode(ids) == ("x" + " " * 1_500_000 + "y").encode()


def test_rows(codec, docs):
    rows = [*ODD, (9, "long words " * 5000)]

    def expected(text):
        ids = codec.library.encode_ordinary(text or "")
        return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()

    got = by_id(bpe.digest(docs(*rows)), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted(((i, *expected(t)) for i, t in rows), key=lambda r: tuple((x is None, str(x)) for x in r))
    assert bpe.digest(docs()).count() == 0


def test_decode_column(docs):
    path, pattern = public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN
    tokens = bpe.encode_texts(docs(*ODD), path, pattern)
    got = by_id(bpe.decode_ids(tokens, path, pattern), "doc_id", "data")
    assert sorted(bytes(d) for _, d in got) == sorted((t or "").encode() for _, t in ODD)
