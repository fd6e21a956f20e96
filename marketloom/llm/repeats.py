"""Removing repeated byte strings with suffix arrays.

Every byte covered by a string of LENGTH bytes that also starts elsewhere goes. No
suffix array of the whole corpus is built; the strings are first brought together:

1. Each window of LENGTH bytes has one anchor, its first K-gram of least hash: a function
   of the window alone, so equal windows have equal anchors. Neighbouring windows share
   anchors, so a document is a short list of (anchor hash, context), the context being
   the bytes of all windows of that anchor.
2. Anchors seen once are dropped. Contexts of one anchor that are all equal need no
   further look: all their windows repeat.
3. One copy of every other context goes to the task of its anchor. There an enhanced
   suffix array of the contexts is scanned with a stack for intervals of common prefixes
   of at least LENGTH bytes; intervals with different bytes to the left are the maximal
   repeats, and all occurrences of each are marked.
4. Anchors with very many different contexts (the edges of a passage that is everywhere)
   are not gathered: their windows are counted by digest in an aggregate that adds up
   before it shuffles. Both ways are exact, they only differ in where the work is done.

Each document's marks come back to its text in one join by (id, text mark).

Defined results: a null text has no bytes; texts shorter than LENGTH keep everything;
rows with equal id and text are two occurrences of everything in them; an empty table
gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.llm.common import forget, spread, table, text_or_empty
from marketloom.session import materialize

LENGTH, K = 200, 40
PIECE_BYTES = 1 << 19
BATCH_BYTES = 1 << 20
HOT_CONTEXTS = 4000
NO_ID = -(2**63)

_rng = np.random.Generator(np.random.PCG64(20240601))
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    if size not in _powers:
        one = np.ones(1, np.uint64)
        _powers[size] = tuple(np.cumprod(np.concatenate([one, np.full(size - 1, x)])) for x in (_BASE, _INVERSE))
    return _powers[size]


def anchors(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash, context hash, first window, windows) of every anchor of one run of bytes."""
    n = len(data)
    width = LENGTH - K + 1
    grams = _BYTE[data]
    parts, size = {}, 1
    while True:
        parts[size] = grams
        if size * 2 > K:
            break
        power = np.uint64(pow(int(_BASE), size, 2**64))
        grams = grams[:-size] * power + grams[size:]
        size *= 2
    whole, done = None, 0
    for size in sorted((s for s in parts if K & s), reverse=True):
        part = parts[size][done : done + n - K + 1]
        whole = part if whole is None else whole * np.uint64(pow(int(_BASE), size, 2**64)) + part
        done += size
    whole = _mix(whole)
    # hash above, place below: the least is the first place of the least hash
    least = (whole & np.uint64(0xFFFFFFFFFFF00000)) | np.arange(len(whole), dtype=np.uint64)
    size = 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if width > size:
        least = np.minimum(least[: -(width - size)], least[width - size :])
    place = (least & np.uint64(0xFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    count = np.diff(np.concatenate([first, [len(place)]]))
    powers, inverses = _power_tables(n + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * powers[:n])])
    span = count + LENGTH - 1
    context = _mix((total[first + span] - total[first]) * inverses[first] + span.astype(np.uint64))
    return whole[place[first]], context, first, count


def document_anchors(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of a whole document, taken in pieces of bounded size that overlap by less than a window."""
    found = [[], [], [], []]
    for at in range(0, len(data) - LENGTH + 1, PIECE_BYTES):
        own = anchors(data[at : at + PIECE_BYTES + LENGTH - 1])
        for out, values in zip(found, (own[0].view(np.int64), own[1].view(np.int64), own[2] + at, own[3])):
            out.append(values)
    return tuple(np.concatenate(values) if values else np.empty(0, np.int64) for values in found)


def _all_anchors(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sizes, columns = [], [[], [], [], []]
                for text in part.column(3):
                    data = np.frombuffer(text.as_buffer() or b"", np.uint8)
                    sizes.append(len(data))
                    for out, values in zip(columns, document_anchors(data)):
                        out.append(values)
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(v) for v in columns[0]])]), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(c), kind)) for c, kind in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(sizes, pa.int64()), *lists], names=["row", "id", "mark", "n_bytes", "h", "x", "s", "c"])

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("mark"),
        text_or_empty().alias("text"),
    )
    return rows.mapInArrow(run, "row bigint, id bigint, mark bigint, n_bytes bigint, h array<bigint>, x array<bigint>, s array<int>, c array<int>")


def prefix_intervals(lcp: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of every interval of the common-prefix tree with depth >= least; lcp[i] belongs to entries i-1 and i."""
    runs = np.flatnonzero(np.diff(np.concatenate([[False], lcp >= least, [False]]).astype(np.int8)))
    for start, stop in zip(runs[::2].tolist(), runs[1::2].tolist()):
        stack: list[tuple[int, int]] = []
        for i, depth in enumerate(lcp[start:stop].tolist(), start):
            left = i - 1
            while stack and stack[-1][0] > depth:
                above, left = stack.pop()
                yield above, left, i - 1
            if not stack or stack[-1][0] < depth:
                stack.append((depth, left))
        while stack:
            above, left = stack.pop()
            yield above, left, stop - 1


def maximal_repeats(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> Iterator[tuple[int, np.ndarray]]:
    """(length, starts) of the maximal repeats of at least ``length`` bytes among the given suffixes.

    ``ends`` bounds each suffix. A suffix whose predecessor is not given counts as a
    different left extension.
    """
    if len(starts) < 2:
        return
    strides = -(-int((ends - starts).max()) // 128)
    word = np.zeros(len(data) + 128 * (strides + 2), np.uint64)
    padded = np.concatenate([data, np.zeros(128 * (strides + 3), np.uint8)])
    for j in range(8):
        word = (word << np.uint64(8)) | padded[j : j + len(word)]
    rank = {8: np.unique(word, return_inverse=True)[1].astype(np.int32)}
    size = 8
    while size < 128:
        pair = rank[size][:-size].astype(np.uint64) << np.uint64(32) | rank[size][size:].astype(np.uint64)
        size *= 2
        rank[size] = np.unique(pair, return_inverse=True)[1].astype(np.int32)
    order = np.lexsort([rank[128][starts + 128 * i] for i in reversed(range(strides))])
    array, bound = starts[order], ends[order]
    a, b = array[:-1], array[1:]
    same, common = np.ones(len(a), bool), np.zeros(len(a), np.int64)
    for size in (*[128] * strides, 64, 32, 16, 8):
        # a failed step leaves the place where the smaller ones go on
        common += np.where(rank[size][a + common] == rank[size][b + common], size, 0)
    for _ in range(7):
        same &= padded[a + common] == padded[b + common]
        common += same
    lcp = np.concatenate([[0], np.minimum(common, np.minimum(bound[:-1] - a, bound[1:] - b))])
    given = np.zeros(len(data) + 1, bool)
    given[starts] = True
    before = np.where((array > 0) & given[array - 1], data[array - 1].astype(np.int64), -1 - np.arange(len(array)))
    changes = np.concatenate([[0], np.cumsum(before[1:] != before[:-1])])
    for depth, first, last in prefix_intervals(lcp, length):
        if changes[last] > changes[first]:
            yield depth, array[first : last + 1]


def _repeated_windows(contexts: list[bytes], counts: list[int], copies: list[int]) -> list[list[tuple[int, int]]]:
    """Per context the runs [from, to) of its windows that start elsewhere too."""
    data = np.frombuffer(b"".join(contexts), np.uint8)
    sizes = np.array([len(c) for c in contexts])
    base = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    counts_ = np.array(counts)
    starts = np.repeat(base, counts_) + np.arange(counts_.sum()) - np.repeat(np.cumsum(counts_) - counts_, counts_)
    ends = np.repeat(base + sizes, counts_)
    step = np.zeros(len(data) + 2, np.int64)
    for depth, occurrences in maximal_repeats(data, starts, ends):
        np.add.at(step, occurrences, 1)
        np.add.at(step, occurrences + depth - LENGTH + 1, -1)
    covered = np.cumsum(step) > 0
    out = []
    for at, count, n in zip(base.tolist(), counts, copies):
        if n > 1:
            out.append([(0, count)])
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[False], covered[at : at + count], [False]]).astype(np.int8))).tolist()
        out.append(list(zip(edge[::2], edge[1::2])))
    return out


_RUNS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _scan_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (h, x, c, n, context) sorted by h in; (h, x, runs) out. Groups are taken together up to a bounded size."""
    held: list[tuple] = []
    size = 0

    def flush(rows):
        runs = _repeated_windows([r[4] for r in rows], [r[2] for r in rows], [r[3] for r in rows])
        kept = [(r[0], r[1], [{"a": a, "b": b} for a, b in own]) for r, own in zip(rows, runs) if own]
        columns = list(zip(*kept)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], _RUNS)], names=["h", "x", "runs"])

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if size > BATCH_BYTES and row[0] != held[-1][0]:
                yield flush(held)
                held, size = [], 0
            held.append(row)
            size += len(row[4])
    if held:
        yield flush(held)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, x, place, digest, n) of every window of every context."""
    for batch in batches:
        for h, x, c, n, context in zip(*(col.to_pylist() for col in batch.columns)):
            marks = [hashlib.md5(context[i : i + LENGTH]).digest() for i in range(c)]
            columns = [pa.array([h] * c, pa.int64()), pa.array([x] * c, pa.int64()), pa.array(range(c), pa.int32()), pa.array(marks, pa.binary()), pa.array([n] * c, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["h", "x", "place", "digest", "n"])


def _contexts(docs: DataFrame, keys: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h, x, c, n, hot, context) read from the texts; ``wanted`` has one place (row, s) for each."""
    per_row = wanted.groupBy("row").agg(F.collect_list(F.struct("h", "x", "c", "n", "hot", "s")).alias("places")).join(keys, "row").select("id", "mark", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, places in zip(*batch.columns):
                data, places = text.as_buffer().to_pybytes(), places.as_py()
                columns = [pa.array([p[k] for p in places], kind) for k, kind in (("h", pa.int64()), ("x", pa.int64()), ("c", pa.int32()), ("n", pa.int64()), ("hot", pa.bool_()))]
                cut = pa.array([data[p["s"] : p["s"] + p["c"] + LENGTH - 1] for p in places], pa.binary())
                yield pa.RecordBatch.from_arrays([*columns, cut], names=["h", "x", "c", "n", "hot", "context"])

    return _keyed(docs).join(per_row, ["id", "mark"]).select("text", "places").mapInArrow(run, "h bigint, x bigint, c int, n bigint, hot boolean, context binary")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("mark"), text_or_empty().alias("text"))


def repeat_spans(docs: DataFrame) -> DataFrame:
    """(id, mark, spans): per distinct document its byte ranges [from, to) to remove, unsorted and overlapping; none: null."""
    spark = docs.sparkSession
    own = materialize(_all_anchors(docs), "anchors")
    every = own.select("row", F.explode(F.arrays_zip("h", "x", "s", "c")).alias("a")).select("row", "a.*")
    seen = every.groupBy("h").agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).where("n > 1")
    again = materialize(every.join(seen, "h").select("row", "h", "x", "s", "c", (F.col("low") == F.col("high")).alias("same")), "again")
    forget(spark)
    various = again.where("NOT same").groupBy("h", "x", "c").agg(F.count("*").alias("n"), F.min("row").alias("row"), F.min_by("s", "row").alias("s"))
    various = materialize(various, "various")
    groups = various.groupBy("h").agg((F.count("*") > HOT_CONTEXTS).alias("hot"))
    contexts = materialize(_contexts(docs, own.select("row", "id", "mark"), various.join(groups, "h")), "contexts")
    forget(spark)
    cold = contexts.where("NOT hot").select("h", "x", "c", "n", "context").repartition(spread(spark), "h").sortWithinPartitions("h")
    runs = cold.mapInArrow(_scan_contexts, "h bigint, x bigint, runs array<struct<a:int,b:int>>")
    windows = contexts.where("hot").select("h", "x", "c", "n", "context").mapInArrow(_windows, "h bigint, x bigint, place int, digest binary, n bigint")
    windows = materialize(windows, "windows")
    often = windows.groupBy("digest").agg(F.sum("n").alias("n")).where("n > 1").select("digest")
    hot = windows.drop("n").join(often, "digest").select("h", "x", F.array(F.struct(F.col("place").alias("a"), (F.col("place") + 1).alias("b"))).alias("runs"))
    runs = materialize(runs.unionByName(hot), "runs")
    moved = again.where("NOT same").join(runs, ["h", "x"]).select("row", "s", F.explode("runs").alias("r"))
    last = F.col("s") + LENGTH - 1
    ranges = moved.select("row", (F.col("s") + F.col("r.a")).alias("from"), (last + F.col("r.b")).alias("to"))
    ranges = ranges.unionByName(again.where("same").select("row", F.col("s").alias("from"), (last + F.col("c")).alias("to")))
    spans = materialize(ranges.groupBy("row").agg(F.collect_list(F.struct("from", "to")).alias("spans")), "spans")
    forget(spark)
    first = own.groupBy("id", "mark").agg(F.min("row").alias("row"))
    return first.join(spans, "row", "left").select("id", "mark", "spans")


def union(spans) -> list[tuple[int, int]]:
    """Sorted disjoint ranges that cover the same bytes; ranges that touch are one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(r) for r in out]


def cut(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for a, b in spans:
        kept.append(data[at:a])
        at = b
    return b"".join([*kept, data[at:]])


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``, the remaining bytes."""

    @F.pandas_udf(T.StructType([T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType())]))
    def remove(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for text, own in zip(texts, spans):
            if own is None or text is None:
                out.append((0, 0, None))
                continue
            joined = union([(r["from"], r["to"]) for r in own])
            out.append((sum(b - a for a, b in joined), len(joined), cut(text.encode("utf-8", "surrogatepass"), joined)))
        return pd.DataFrame(out, columns=["n_removed", "n_spans", "kept"])

    rows = _keyed(docs).join(repeat_spans(docs), ["id", "mark"])
    rows = rows.withColumn("cut", remove(F.when(F.col("spans").isNotNull(), F.col("text")), "spans"))
    kept = F.when(F.col("spans").isNull(), F.col("text").cast("binary")).otherwise(F.col("cut.kept"))
    return rows.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "cut.n_removed", "cut.n_spans", kept.alias("kept"))


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is removed from every document, and a digest of what stays."""
    rows = without_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
