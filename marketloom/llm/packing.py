"""Packing token sequences: vector bin packing by the dot-product heuristic.

An example is a vector of (tokens, segments, loss-bearing tokens), a sequence a bin with a
limit on each. A bin is filled with the waiting example whose vector has the greatest dot
product with what the bin has left, every dimension divided by its limit and weighted by
the demand of the waiting ones, until none fits whole. What is left open is filled with a
piece of the longest example, whose rest waits on. A bin that even then stays open (too
many segments or loss-bearing tokens, or nothing waits any more) is cut back to a power of
two, so no sequence needs padding. Examples longer than a bin give whole bins first.

The loss-bearing tokens of a piece are those from ``loss_from`` of its document on, without
the first of the piece, which has nothing before it.

Every task packs the rows it reads, in their order, holding POOL examples at most; nothing
is shuffled, no group is gathered, and only the last few bins of a task are short. A task
that runs again reads the same rows again, so its sequences come out the same; rows that do
not come from a table have to be sorted within their partitions for that.

Tokens are those of the vocabulary's public library. A long text is cut where white space
follows something else, which is always a border of its splitting rule.

Defined results: a null text is empty and has the closing id alone; null and repeated ids
and repeated rows are documents of their own, told apart by (sequence, offset); strings of
special tokens in a text are read as the library reads them; very long texts are read in
parts; an empty table gives no pieces; further columns are not read and cannot clash.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.common import table, text_or_empty

VOCABULARY = "byte_bpe_50k.json"
TOKENS, SEGMENTS, LOSS_TOKENS = 1024, 64, 1024
END_ID = 0
POOL = 256
SLICE_CHARS = 1 << 20
MEMO_CHARS, MEMO_PARTS = 64, 1 << 18
# fixed values: Unicode white space, as the splitting rule knows it
BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PART = re.compile(f"[{BLANK}]*[^{BLANK}]+|[{BLANK}]+")
BORDER = re.compile(f"(?<=[^{BLANK}])(?=[{BLANK}])")


# characters that have been letters, digits, white space or none of them in every version of Unicode that libraries may follow
ODD = re.compile("[^\x00-\u024f\u0391-\u03a1\u03a3-\u03c9\u0400-\u0481\u2000-\u200a\u2010-\u2029\u202f-\u205f\u2190-\u23ff\u2500-\u27bf\u3000-\u3003\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3\U0001f300-\U0001f6ff]")
LONG_BLANK = re.compile(f"[{BLANK}]{{65536}}")


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers, as the vocabulary's own library gives them.

    If the vocabulary's merges stand in the order of their ids and its splitting ``pattern``
    is given, texts without odd characters, strings of special tokens and endless white space
    are encoded by rank, which gives the same ids faster. All others go to the vocabulary's
    library part by part, each part once while it is remembered.
    """

    def __init__(self, path: str, pattern: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        special = [t["content"] for t in stated["added_tokens"]]
        if any(re.search(f"[{BLANK}]", t) for t in special):
            raise ValueError("a special token with white space in it would be cut")
        self.special = re.compile("|".join(map(re.escape, special)) or "(?!)")
        self.by_rank = _ranks(stated["model"], set(special), pattern) if pattern else None

    def encode(self, text: str) -> bytes:
        out, at = [], 0
        while at < len(text):
            border = BORDER.search(text, at + SLICE_CHARS) if len(text) - at > SLICE_CHARS else None
            stop = border.start() if border else len(text)
            out.append(self._slice(text[at:stop] if at or border else text))
            at = stop
        return b"".join(out)

    def _slice(self, text: str) -> bytes:
        if self.by_rank and not ODD.search(text) and not self.special.search(text) and not LONG_BLANK.search(text):
            return np.asarray(self.by_rank.encode_ordinary(text), "<u4").tobytes()
        parts = PART.findall(text)
        new = list(dict.fromkeys(p for p in parts if p not in self.known))
        found = self.library.encode_batch_fast(new, add_special_tokens=False)
        fresh = {p: np.asarray(e.ids, "<u4").tobytes() for p, e in zip(new, found)}
        out = b"".join([self.known.get(p) or fresh[p] for p in parts])
        if len(self.known) + len(fresh) > MEMO_PARTS:
            self.known.clear()
        self.known |= {p: ids for p, ids in fresh.items() if len(p) <= MEMO_CHARS}
        return out


def _ranks(model: dict, special: set[str], pattern: str):
    """The vocabulary as ranks of byte strings, or None where merging by rank would not be the same."""
    import tiktoken

    vocabulary = model["vocab"]
    order = [vocabulary.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    if None in order or order != sorted(order):
        return None
    # printable characters stand for their bytes, characters from 256 on for the other bytes, in order
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown)}
    ranks = {bytes(map(letters.__getitem__, t)): i for t, i in vocabulary.items() if t not in special}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


_encoders: dict[tuple[str, str | None], Encoder] = {}


def encoder(path: str, pattern: str | None) -> Encoder:
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(path, pattern)
    return _encoders[path, pattern]


@dataclass(frozen=True, slots=True)
class Piece:
    """Ids ``start`` to ``stop`` of a document; ``ids`` are the document's own ones from ``base`` on."""

    key: object
    ids: bytes
    base: int
    total: int
    loss_from: int
    start: int
    stop: int

    @property
    def tokens(self) -> int:
        return self.stop - self.start

    def loss(self) -> int:
        return max(0, self.stop - max(self.start + 1, self.loss_from))

    def prefix(self, tokens: int, loss: int) -> int:
        """Tokens of the longest beginning inside both limits."""
        return min(tokens, self.tokens, max(self.start + 1, self.loss_from) - self.start + loss)

    def cut(self, tokens: int) -> tuple[Piece, Piece]:
        middle = self.start + tokens
        return (
            Piece(self.key, self.ids, self.base, self.total, self.loss_from, self.start, middle),
            Piece(self.key, self.ids, self.base, self.total, self.loss_from, middle, self.stop),
        )

    def data(self) -> bytes:
        return self.ids[4 * (self.start - self.base) : 4 * (self.stop - self.base)]

    def alone(self) -> Piece:
        """The same without the ids of the rest of its document."""
        return Piece(self.key, self.data(), self.start, self.total, self.loss_from, self.start, self.stop)


class Packer:
    """Bins under limits on (tokens, segments, loss-bearing tokens), filled from a bounded pool of waiting pieces."""

    def __init__(self, tokens: int = TOKENS, segments: int = SEGMENTS, loss_tokens: int = LOSS_TOKENS, pool: int = POOL):
        if min(tokens, segments, pool) < 1 or loss_tokens < 0:
            raise ValueError("limits must leave room for one token")
        self.limits = np.array([tokens, segments, max(loss_tokens, 1)], float)
        self.tokens, self.segments, self.loss_tokens, self.pool = tokens, segments, loss_tokens, pool
        self.waiting: list[Piece] = []
        self.demand = np.zeros((0, 3))

    def _wait(self, pieces: list[Piece]) -> None:
        if pieces:
            self.waiting += pieces
            self.demand = np.vstack([self.demand, [(p.tokens, 1, p.loss()) for p in pieces]])

    def _take(self, at: int) -> Piece:
        """A waiting piece; the last one moves to its place."""
        piece, last = self.waiting[at], self.waiting.pop()
        if at < len(self.waiting):
            self.waiting[at], self.demand[at] = last, self.demand[-1]
        self.demand = self.demand[:-1]
        return piece

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        """Whole bins that come from one more document."""
        while piece.prefix(self.tokens, self.loss_tokens) == self.tokens:
            head, piece = piece.cut(self.tokens)
            yield [head]
        if piece.tokens:
            self._wait([piece.alone()])
        while len(self.waiting) >= self.pool:
            yield self._close()

    def finish(self) -> Iterator[list[Piece]]:
        while self.waiting:
            yield self._close()

    def _close(self) -> list[Piece]:
        taken: list[Piece] = []
        left = np.array([self.tokens, self.segments, self.loss_tokens], float)
        weight = self.demand.sum(0) / self.limits**3
        while self.waiting and left[1] > 1 and left[0]:
            fits = (self.demand <= left).all(1)
            if not fits.any():
                break
            best = int(np.argmax(np.where(fits, self.demand @ (weight * left), -1.0)))
            left -= self.demand[best]
            taken.append(self._take(best))
        while self.waiting and left[0] and left[1]:
            # what stays open is filled by a piece; tokens without loss come first in it
            room = np.minimum(np.minimum(left[0], self.demand[:, 0]), self.demand[:, 0] - self.demand[:, 2] + left[2])
            best = int(np.argmax(room))
            head, rest = self._take(best).cut(int(room[best]))
            if rest.tokens:
                self._wait([rest])
            taken.append(head)
            left -= (head.tokens, 1, head.loss())
        return self._cut_back(taken)

    def _cut_back(self, taken: list[Piece]) -> list[Piece]:
        """The bin as it is if full, else its longest beginning of a power of two; the rest waits again."""
        used = sum(p.tokens for p in taken)
        over = 0 if used == self.tokens else used - (1 << (used.bit_length() - 1))
        while over:
            last = taken.pop()
            if last.tokens > over:
                last, rest = last.cut(last.tokens - over)
                taken.append(last)
            else:
                rest = last
            self._wait([rest])
            over -= rest.tokens
        return taken


def pack(docs: DataFrame, path: str, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text", loss_from: str | None = None, **limits: int) -> DataFrame:
    """Pieces of all documents in sequences: (id, start, length, ids, doc_tokens, sequence_id, offset).

    ``path`` names the vocabulary and ``pattern`` its splitting rule (see Encoder).
    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit integers. ``loss_from``
    names a column with the first loss-bearing token of a document (default: all bear loss).
    """
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    closing = np.asarray([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, packer = encoder(path, pattern), Packer(**limits)
        sequence = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        kind = None

        def keep(bins: Iterator[list[Piece]]) -> None:
            nonlocal sequence
            for pieces in bins:
                offset = 0
                for p in pieces:
                    rows.append((p.key, p.start, p.tokens, p.data(), p.total, sequence, offset))
                    offset += p.tokens
                sequence += 1

        def out() -> pa.RecordBatch:
            columns = [pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 7, [kind, *kinds])]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names=[id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            kind = batch.column(0).type
            for key, text, first in zip(batch.column(0), batch.column(1), batch.column(2)):
                ids = codec.encode(text.as_py()) + closing
                total, first = len(ids) // 4, first.as_py() or 0
                keep(packer.add(Piece(key.as_py(), ids, 0, total, first, 0, total)))
                if len(rows) >= 2048:
                    yield out()
        keep(packer.finish())
        if rows:
            yield out()

    first = F.col(f"`{loss_from}`").cast("bigint") if loss_from else F.lit(0).cast("bigint")
    return docs.select(F.col(f"`{id_col}`"), text_or_empty(f"`{text_col}`").alias("text"), first.alias("loss_from")).mapInArrow(run, schema)


def op11_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in sequences of 1024 tokens, with the checksum of its ids."""
    import public_tokenizers

    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
