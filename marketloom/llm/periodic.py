"""Runs of periodic words by internal pattern matching.

A run is a stretch of words with smallest period q that no neighbour extends and that is
long enough. With b the power of two above q, words 0 to 3q of the run hold an aligned
dyadic block, b words from a multiple of b / 2, whose next occurrence is exactly q words on:
a nearer one would give the stretch a smaller period. All occurrences in the window after
the block form one progression, and the distance of the first two is the candidate period.

The documents of a batch are written as one sequence of symbols, words of different
documents being different symbols, so nothing matches across documents. Prefix doubling
sorts its suffixes; equal blocks of each dyadic length are intervals of the suffix array.
The next occurrence of a block is a range successor: the least entry of its interval above
its own place, found with a wavelet tree over the suffix array. A candidate is then extended
both ways by comparing words, which finds the whole run and its exact length.

Documents are independent rows: nothing is shuffled, and a batch of documents is bounded in
words (one document may exceed it).

Defined results: a null or empty text has no words and no runs; repeated rows repeat their
answer; of runs with equal length / period the first is the best, then that of smaller
period; an empty table gives an empty result; further columns are not read and cannot clash.
"""

from __future__ import annotations

import string
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.common import WORD, table, text_or_empty

MIN_WORDS, MIN_EXPONENT = 6, 4
BATCH_WORDS = 1 << 17
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
# bytes.split() without a separator cuts at exactly the white space of the contract (fixed values)
assert set(string.whitespace) == set(" \t\n\r\x0b\x0c")


def dyadic_blocks(symbols: np.ndarray):
    """Suffix array of ``symbols`` and the repeated aligned blocks: (sa, repeated, place, length, low, high).

    ``repeated`` are the suffix array's indexes whose first two symbols occur again;
    ``low`` and ``high`` bound a block's interval in them.
    """
    n = len(symbols)
    sa = np.argsort(symbols, kind="stable")
    by_rank = symbols[sa]
    first = np.flatnonzero(np.r_[True, by_rank[1:] != by_rank[:-1]]) if n else np.zeros(0, np.int64)
    size = np.diff(np.r_[first, n])
    rank = np.empty(n, np.int64)
    rank[sa] = np.repeat(first, size)
    following = np.full(n, n + n, np.int64)  # place of the next equal symbol
    same = np.flatnonzero(by_rank[1:] == by_rank[:-1])
    following[sa[same]] = sa[same + 1]
    at = np.flatnonzero(np.repeat(size, size) > 1)
    repeated, found, length = np.zeros(0, np.int64), [], 1
    while len(at):
        place = sa[at]
        ahead = place + length
        key = rank[place] * (n + 1) + np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        order = np.argsort(key)
        place, key = place[order], key[order]
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[new, len(key)])
        low, size = np.repeat(at[new], size), np.repeat(size, size)
        sa[at], rank[place] = place, low
        length *= 2
        again = size > 1
        at = at[again]
        if length == 2:
            repeated = at
        # a block that occurs less than its length further on has its first word there
        mine = again & (place % (length // 2) == 0) & (following[place] - place < length)
        if mine.any():
            found.append((place[mine], np.full(mine.sum(), length), low[mine], low[mine] + size[mine]))
    place, width, low, high = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 4
    low_in = np.searchsorted(repeated, low)
    return sa, repeated, place, width, low_in, low_in + (high - low)


class WaveletTree:
    """Range counts and order statistics over non-negative integers, for many queries at once."""

    def __init__(self, values: np.ndarray):
        self.levels = []
        now = values
        for bit in reversed(range(max(1, int(values.max(initial=0)).bit_length()))):
            one = (now >> bit & 1).astype(bool)
            zeros = np.zeros(len(now) + 1, np.int32)
            np.cumsum(~one, out=zeros[1:])
            self.levels.append((bit, zeros, int(zeros[-1])))
            now = np.concatenate([now[~one], now[one]])

    def successor(self, low: np.ndarray, high: np.ndarray, above: np.ndarray) -> np.ndarray:
        """Least value of each range that is greater than ``above``; -1 where there is none."""
        rank = self._at_most(low, high, above)
        there = rank < high - low
        out = np.full(len(low), -1, np.int64)
        out[there] = self._nth(low[there], high[there], rank[there])
        return out

    def _at_most(self, low, high, value):
        total, value = np.zeros(len(low), np.int64), value + 1
        for bit, zeros, n_zeros in self.levels:
            low0, high0 = zeros[low], zeros[high]
            one = (value >> bit & 1).astype(bool)
            total += np.where(one, high0 - low0, 0)
            low, high = np.where(one, n_zeros + low - low0, low0), np.where(one, n_zeros + high - high0, high0)
        # values above all of the tree's bits exceed every entry
        over = value >> (self.levels[0][0] + 1) > 0
        return np.where(over, np.iinfo(np.int64).max, total)

    def _nth(self, low, high, nth):
        out = np.zeros(len(low), np.int64)
        for bit, zeros, n_zeros in self.levels:
            low0, high0 = zeros[low], zeros[high]
            inside = high0 - low0
            one = nth >= inside
            out |= one.astype(np.int64) << bit
            nth = np.where(one, nth - inside, nth)
            low, high = np.where(one, n_zeros + low - low0, low0), np.where(one, n_zeros + high - high0, high0)
        return out


def _extend(symbols: np.ndarray, start: int, stop: int, period: int) -> tuple[int, int]:
    """The whole stretch of ``period`` around [start, stop), a stretch of that period."""
    n, step, at = len(symbols), 64, stop - period
    while at + period < n:
        size = min(step, n - period - at)
        differ = symbols[at : at + size] != symbols[at + period : at + period + size]
        first = int(differ.argmax())
        if differ[first]:
            at += first
            break
        at, step = at + size, step * 2
    stop, step = at + period, 64
    while start > 0:
        size = min(step, start)
        differ = symbols[start - size : start] != symbols[start - size + period : start + period]
        last = int(differ[::-1].argmax())
        if differ[size - 1 - last]:
            start -= last
            break
        start, step = start - size, step * 2
    return start, stop


def runs_of(symbols: np.ndarray, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period."""
    sa, repeated, place, width, low, high = dyadic_blocks(symbols)
    if not len(place):
        return []
    following = WaveletTree(sa[repeated]).successor(low, high, place)
    period = following - place
    near = (following >= 0) & (period >= width // 2) & (period < width)
    place, width, period = place[near], width[near], period[near]
    order = np.lexsort((place, period))
    out, done, done_period = [], -1, 0
    for at, block, q in zip(place[order].tolist(), width[order].tolist(), period[order].tolist()):
        if q == done_period and at + block + q <= done:
            continue
        start, done = _extend(symbols, at, at + block + q, q)
        done_period = q
        if done - start >= max(min_words, min_exponent * q):
            out.append((start, done - start, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep)])


def _answers(texts: list[list[bytes]], min_words: int, min_exponent: int) -> Iterator[tuple[list, bytes]]:
    """Per document of a batch its runs and its collapsed text."""
    number = count()
    symbols, ends = [], []
    for words in texts:
        own: defaultdict = defaultdict(number.__next__)
        symbols.append(np.fromiter(map(own.__getitem__, words), np.int64, len(words)))
        ends.append(len(words))
    ends = np.cumsum(ends)
    per_text: list[list] = [[] for _ in texts]
    for start, length, period in runs_of(np.concatenate(symbols), min_words, min_exponent) if len(texts) else []:
        at = int(np.searchsorted(ends, start, "right"))
        per_text[at].append((start - int(ends[at] - len(texts[at])), length, period))
    for words, runs in zip(texts, per_text):
        yield runs, _collapsed(words, runs)


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """Per row its id, ``runs`` (array of start, length, period in words) and ``collapsed``, the text without what runs repeat.

    A run has at least ``min_words`` words and ``min_exponent`` (4 or more) times its period.
    """
    if min_exponent < 4:
        raise ValueError("an aligned block is certain to lie in runs of four periods or more")
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, first, held = [], 0, 0
            column = batch.column(1).cast(pa.binary())
            for at in range(batch.num_rows):
                texts.append(column[at].as_py().split())
                held += len(texts[-1])
                if held >= BATCH_WORDS or at == batch.num_rows - 1:
                    runs, collapsed = zip(*_answers(texts, min_words, min_exponent))
                    runs = [[dict(zip(("start", "length", "period"), r)) for r in x] for x in runs]
                    columns = [batch.column(0).slice(first, len(texts)), pa.array(runs, RUNS), pa.array(collapsed, pa.binary()).cast(pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, names=[id_col, "runs", "collapsed"])
                    texts, first, held = [], at + 1, 0

    return docs.select(F.col(f"`{id_col}`"), text_or_empty(f"`{text_col}`").alias("text")).mapInArrow(run, schema)


def planted(doc_id: Column, text: Column) -> Column:
    """The text, made periodic from a word on where crc32(doc_id as text) is divisible by ten; null ids are left alone."""
    mark = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n, g = F.size(words), F.floor(mark / 10)

    def repeat(x: Column) -> Column:
        """From a struct of the words, a and p."""
        from_a = F.transform(F.sequence(F.lit(0), F.size(x["w"]) - 1), lambda i: F.get(x["w"], F.when(i < x["a"], i).otherwise(x["a"] + (i - x["a"]) % x["p"]).cast("int")))
        return F.array_join(from_a, " ")

    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    made = F.transform(F.array(F.struct(words.alias("w"), a.alias("a"), p.alias("p"))), repeat)
    return F.when((mark % 10 == 0) & F.regexp_like(text, F.lit(WORD)), F.get(made, F.lit(0))).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document's words, the one of greatest exponent, and the digest of what stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", planted(F.col("doc_id"), text_or_empty()).alias("text"))
    found = find_runs(docs)
    more = lambda x, y: y["length"] * x["period"] - x["length"] * y["period"]
    ahead = lambda x, y: F.when(more(x, y) != 0, more(x, y)).when(x["start"] != y["start"], x["start"] - y["start"]).otherwise(x["period"] - y["period"])
    best = F.get(F.array_sort("runs", lambda x, y: F.signum(ahead(x, y)).cast("int")), F.lit(0))
    line = lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n"))
    told = found.withColumn("best", best)
    return told.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
