"""Toxicity by noisy-channel deobfuscation.

A character trigram model is counted over every text of the corpus. A disguised token
(signs for letters, letters apart, letters repeated) is a lattice of letters; Viterbi
finds its likeliest reading under the channel and the model. The classifier sees the
words as written and as restored.

The classifier: word and word-start features whose odds under toxic labels are surely
higher (lower bound of the log odds) carry their log odds; the sum of the heaviest features of a
text's words, each counted once, goes through a logistic curve. Features come from a
bounded sample of labelled rows (``sample_rows``, the smallest hashes of the ids). The
curve is fitted on evidence that either half gets from the features of the other, so that
chance features do not flatter it. The trigram counts
have at most 64^3 entries, and features come from a bounded number of rows: all that pass
the bound are kept. Scores use the text alone.

Defined results: null and empty texts get the curve's value at no evidence; a null id is
not held out; a document with several labels is toxic if one says so, null labels do not
count; without labels of both kinds every score is 0; repeated rows repeat their score;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.common import table, text_or_empty

SYMBOLS = 64
OTHER = SYMBOLS - 1
SAMPLE_ROWS = 20_000
THRESHOLD = 0.7
STARTS = (4, 5)
# least lower bound of a feature's log odds, and the normal quantile of that bound
LEAST_LOG_ODDS, BOUND_SD = 2.0, 1.64
CACHE_WORDS, FLUSH_FEATURES = 400_000, 200_000
COUNTS = ("clean0", "toxic0", "clean1", "toxic1")

# what a sign can stand for (fixed values of the channel)
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
SEPARATORS = set(".-_*'`~^,/\\ ")
# costs in nats: reading a sign as a letter, leaving a separator out, dropping a repeated letter, keeping a sign as it is
READ, SKIP, DROP, DROP_LONG, KEEP = 0.7, 0.3, 4.5, 0.4, 5.0

EDGES = re.compile(r"^[^\w$@(|€£!]+|[^\w$]+$")
LETTER = re.compile(r"[^\W\d_]")
LONG_RUN = re.compile(r"(.)\1\1")
SIGN_IN_WORD = re.compile(r"[^\W\d_][^\W_]*[\d@$!|+(€£¡.\-_*'`~^/\\]|[\d@$!|+(€£¡]+[^\W\d_]")
APART = re.compile(r"(?:(?<=\s)|^)(?:[^\W_]|[@$!|])(?:[ .\-_*](?:[^\W_]|[@$!|])){2,}(?=[\s,.;:!?]|$)")

# the end of every match of APART: a cheap sign that there may be one
APART_SIGN = re.compile(r"[ .\-_*][\w@$!|][ .\-_*][\w@$!|](?=[\s,.;:!?]|$)")


def _symbol_table() -> np.ndarray:
    """Code points below 0x250 to symbols: 0 for what is no letter, 1-26 for a-z, further letters folded into the rest."""
    out = np.zeros(0x250, np.uint8)
    for point in range(0x250):
        c = chr(point).lower()
        if "a" <= c <= "z":
            out[point] = ord(c[0]) - 96
        elif c.isalpha():
            out[point] = 27 + point % (OTHER - 27)
    return out


TABLE = _symbol_table()


def symbols(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 0x250, TABLE[np.minimum(points, 0x24F)], OTHER)


def trigram_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(trigram, n) over all texts; each task adds up before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                texts = (t.as_py() for t in batch.column(0).slice(at, 256))
                s = symbols(" " + "  ".join(texts) + " ").astype(np.int32)
                total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], names=["trigram", "n"])

    part = docs.select(text_or_empty(text_col).alias("text")).mapInArrow(run, "trigram int, n bigint")
    return part.groupBy("trigram").agg(F.sum("n").alias("n"))


def letter_costs(counts: dict[int, int]) -> np.ndarray:
    """-log P(c | a, b), the trigram mixed with its bigram and unigram shares."""
    n = np.zeros((SYMBOLS,) * 3)
    for trigram, value in counts.items():
        n.flat[trigram] = value
    two, one = n.sum(0), n.sum((0, 1))
    unigram = (one + 0.5) / (one.sum() + 0.5 * SYMBOLS)
    bigram = (two + 4 * unigram) / (two.sum(1, keepdims=True) + 4)
    return -np.log((n + 4 * bigram) / (n.sum(2, keepdims=True) + 4)).astype(np.float32)


@dataclass
class Restorer:
    """Reads disguised tokens under the letter model."""

    costs: np.ndarray
    known: dict[str, str] = field(default_factory=dict)

    def __getstate__(self):
        return {"costs": self.costs, "known": {}}

    def word(self, token: str) -> str:
        """The likeliest reading of one token, spaces between its letters included."""
        if token not in self.known:
            if len(self.known) > CACHE_WORDS:
                self.known.clear()
            self.known[token] = self._viterbi(token)
        return self.known[token]

    def _viterbi(self, token: str) -> str:
        best: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
        runs = [(c, len(list(g))) for c, g in groupby(token)]
        for c, length in runs:
            for i in range(length):
                options = [(c, 0.0 if c.isalpha() else KEEP)]
                options += [(letter, READ) for letter in SIGNS.get(c, "")]
                if c in SEPARATORS:
                    options.append(("", SKIP))
                elif i:
                    options.append(("", DROP_LONG if length > 2 else DROP))
                following: dict[tuple[int, int], tuple[float, tuple]] = {}
                for (a, b), (cost, path) in best.items():
                    for letter, price in options:
                        if letter:
                            s = int(symbols(letter[0])[0])
                            state, now, way = (b, s), cost + price + float(self.costs[a, b, s]), (path, letter)
                        else:
                            state, now, way = (a, b), cost + price, path
                        if state not in following or now < following[state][0]:
                            following[state] = (now, way)
                best = following
        path = min(((cost + float(self.costs[a, b, 0]), way) for (a, b), (cost, way) in best.items()), key=lambda x: x[0])[1]
        letters = []
        while path:
            path, letter = path
            letters.append(letter)
        return "".join(reversed(letters))

    def disguised(self, word: str) -> bool:
        return bool(SIGN_IN_WORD.search(word) or LONG_RUN.search(word)) and bool(LETTER.search(word))

    def restored(self, text: str) -> str:
        """The text in lower case with every disguised token replaced by its reading."""
        text = APART.sub(lambda m: self.word(m.group()), text.lower())
        return re.sub(r"\S+", lambda m: self.word(w) if self.disguised(w := EDGES.sub("", m.group())) else m.group(), text)


def word_features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}~" for n in STARTS if len(word) > n)]


@dataclass
class Model:
    restorer: Restorer
    weights: dict[str, float]
    bias: float
    slope: float
    known: dict[str, tuple] = field(default_factory=dict)

    def __post_init__(self):
        self.heads = {f.rstrip("~")[:4] for f in self.weights}

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def evidence(self, text: str) -> float:
        return math.fsum(self.weights[f] for f in features(text, self.restorer, self.known, self.heads, self.weights))

    def score(self, text: str | None) -> float:
        if not self.weights:
            return 0.0
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, self.bias + self.slope * self.evidence(text or "")))))


def features(text: str, restorer: Restorer, known: dict, heads: set[str] | None = None, among=None) -> set[str]:
    """Distinct features of the written and the restored words; with weights ``among``, whose heads are ``heads``, the heaviest of every word."""
    text = text.lower()
    words = text.split()
    singles = [i for i, word in enumerate(words) if len(word) == 1]
    distinct = set(words)
    if len(singles) > 2:
        distinct.update(_apart(words, singles, restorer))
    if APART_SIGN.search(text):
        # also before punctuation, and word by word where the gaps between words are wider
        for m in APART.finditer(text):
            distinct.update(_readings(m.group(), restorer))
    out: set[str] = set()
    for word in distinct:
        found = known.get(word)
        if found is None:
            if len(known) > CACHE_WORDS:
                known.clear()
            found = known[word] = _features_of(word, restorer, heads, among)
        if found:
            out.update(found)
    return out


def _apart(words: list[str], singles: list[int], restorer: Restorer) -> Iterator[str]:
    """Words of the readings of three and more one-letter words in a row."""
    start = 0
    for at in range(1, len(singles) + 1):
        if at == len(singles) or singles[at] != singles[at - 1] + 1:
            if at - start > 2:
                yield from _readings(" ".join(words[singles[start] : singles[at - 1] + 1]), restorer)
            start = at


def _readings(run: str, restorer: Restorer) -> Iterator[str]:
    """Words of letters that stand apart; the first letter may not be part of them, nor signs at the end."""
    for letters in {run, run.rstrip(" .,;:!?|")}:
        read = restorer.word(letters)
        for said in (read, read[1:]):
            yield from said.split()


def _features_of(word: str, restorer: Restorer, heads: set[str] | None, among) -> tuple[str, ...]:
    bare = word.strip(".,;:?")
    if bare.isalpha() and not LONG_RUN.search(bare):
        # most words: nothing to restore, and their first letters begin no known feature
        if heads is not None and bare[:4] not in heads:
            return ()
        found = word_features(bare)
    else:
        bare = EDGES.sub("", word)
        found = word_features(bare)
        if restorer.disguised(bare):
            found += word_features(restorer.word(bare))
    if among is None:
        return tuple(f for f in found if f)
    # a word and its start are one piece of evidence
    best = max((f for f in found if f in among), key=among.get, default=None)
    return (best,) if best else ()


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(text, toxic, half) of the labelled rows for learning; the labels sent along are bounded by ``rows``."""
    own = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    own = own.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("__toxic"))
    mark = F.xxhash64(F.col("doc_id"), F.lit("sample"))
    own = own.orderBy(mark, "doc_id").limit(rows).withColumn("__half", F.pmod(mark, F.lit(2)))
    return docs.join(F.broadcast(own), "doc_id").select(text_or_empty().alias("text"), F.col("__toxic").alias("toxic"), F.col("__half").alias("half"))


def _feature_counts(sample: DataFrame, restorer: Restorer) -> list[tuple]:
    """(feature, clean and toxic documents of half 0, of half 1); the row named "" has the numbers of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [Counter() for _ in COUNTS]
        known: dict = {}

        def rows():
            names = list(set().union(*counts))
            columns = [pa.array(names, pa.string()), *(pa.array([c[n] for n in names], pa.int64()) for c in counts)]
            for c in counts:
                c.clear()
            return pa.RecordBatch.from_arrays(columns, names=["feature", *COUNTS])

        for batch in batches:
            for text, toxic, half in zip(*batch.columns):
                own = counts[2 * half.as_py() + (toxic.as_py() == 1)]
                own.update(features(text.as_py(), restorer, known))
                own[""] += 1
                if len(own) > FLUSH_FEATURES:
                    yield rows()
        yield rows()

    schema = "feature string, " + ", ".join(f"{c} bigint" for c in COUNTS)
    counted = sample.mapInArrow(run, schema).groupBy("feature").agg(*(F.sum(c).alias(c) for c in COUNTS))
    keep = counted.where("feature = '' OR (toxic0 + toxic1 >= 3 AND toxic0 + toxic1 > clean0 + clean1)")
    # the sample has a bounded number of rows, and a feature is in three toxic ones at least
    return [tuple(r) for r in keep.orderBy(F.col("feature") != "", "feature").collect()]


def _odds(rows: list[tuple[str, int, int]]) -> dict[str, float]:
    """Log odds of the features that are surely signs of a toxic text, from (feature, clean, toxic)."""
    if not rows or rows[0][0] != "" or not rows[0][1] or not rows[0][2]:
        return {}
    n_clean, n_toxic = rows[0][1:]
    odds: dict[str, float] = {}
    for name, clean, toxic in rows[1:]:
        value = math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))
        if value - BOUND_SD * math.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5)) > LEAST_LOG_ODDS:
            odds[name] = value
    return odds


def _curve(evidence: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Bias and slope of a ridge logistic regression on one number."""
    x, w, ridge = np.column_stack([np.ones(len(evidence)), evidence]), np.zeros(2), np.diag([1e-3, 1e-1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -60, 60)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, x.T @ (toxic - p) - ridge @ w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Letter model over all documents, classifier over a sample of at most ``sample_rows`` labelled ones."""
    restorer = Restorer(letter_costs({r[0]: r[1] for r in trigram_counts(docs).collect()}))
    sample = _sample(docs, labels, sample_rows)
    rows = _feature_counts(sample, restorer)
    model = Model(restorer, _odds([(n, c0 + c1, t0 + t1) for n, c0, t0, c1, t1 in rows]), 0.0, 1.0)
    if not model.weights:
        return model
    # either half is judged by the features of the other
    of_half = [_odds([(r[0], r[3 - 2 * h], r[4 - 2 * h]) for r in rows]) for h in (0, 1)]
    judged = [sample.where(F.col("half") == h).select(evidence_of(Model(restorer, of_half[h], 0, 1))(F.col("text")).alias("x"), "toxic") for h in (0, 1)]
    pairs = np.array([(r[0], r[1]) for r in judged[0].unionByName(judged[1]).collect()], float).reshape(-1, 2)
    model.bias, model.slope = _curve(pairs[:, 0], pairs[:, 1])
    return model


def _column_of(read):
    @F.pandas_udf("double")
    def column(texts: pd.Series) -> pd.Series:
        return texts.map(read, na_action=None)

    return column


def evidence_of(model: Model):
    return _column_of(lambda text: model.evidence(text or ""))


def score_of(model: Model):
    return _column_of(model.score)


def restore_texts(docs: DataFrame, restorer: Restorer, text_col: str = "text") -> DataFrame:
    """The rows with ``restored``, the text as the scorer reads it (null stays null)."""

    @F.pandas_udf("string")
    def read(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else restorer.restored(t), na_action=None)

    return docs.withColumn("restored", read(text_col))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents scored below the threshold, with all their columns."""
    score = score_of(fit(docs, labels))(text_or_empty())
    return docs.where(score < threshold)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and decision for every document."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out().alias("held_out"), score_of(model)(text_or_empty()).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
