"""Exact dedup by deterministic block naming.

The normalised text (white space deleted) is cut into blocks of fixed size. Blocks are
sorted, equal neighbours get one integer name, and pairs of adjacent names are named the
same way, level by level, until each document is one name. Names come from comparing the
blocks themselves, so two documents share (level, name) only if their texts are equal.

Hot blocks: the sort key is (64-bit mark, row), so the rows of one block spread over
partitions by their row number. A partition names its own runs; only the blocks of its
first and last run, a few rows, are compared with those of the other partitions. No
group is ever gathered in one task or on the driver.

Defined results: a null text counts as empty, and all texts without visible characters
are equal; of equal texts the row with the most code points stays, then the smallest id
(null last); of rows that repeat the id as well, one stays; an empty table gives an empty
result; further columns are neither read nor in the way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.llm.common import SPACE, spread, table, text_or_empty, unwrapped, wrapped
from marketloom.session import materialize

BLOCK_BYTES = 8192
NULL_ID = 2**63 - 1


def _with_names(schema: T.StructType, carried: list[str]):
    """A task function: rows sorted by (mark, block) in, rows with ``name`` out, then the blocks of both edges."""
    arrow = {f.name: pa.int64() if isinstance(f.dataType, T.LongType) else pa.binary() for f in schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        count, last_block, last_mark = -1, None, None
        edges: list[tuple[int, bytes]] = []  # of the first run of equal marks, then those of the run at hand
        first_edges: list[tuple[int, bytes]] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            blocks, marks = batch.column("block"), batch.column("mark").to_numpy(zero_copy_only=False)
            new = np.ones(batch.num_rows, bool)
            new[1:] = pc.not_equal(blocks.slice(1), blocks.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
            new[0] = last_block is None or blocks[0].as_py() != last_block
            names = count + np.cumsum(new)
            mark_starts = np.flatnonzero(np.append([last_mark is None or marks[0] != last_mark], marks[1:] != marks[:-1]))
            for start, stop in zip([0, *mark_starts], [*mark_starts, batch.num_rows]):
                if start == 0 or start in (mark_starts[0], mark_starts[-1]):
                    if start in mark_starts:
                        if first_edges is None and last_mark is not None:
                            first_edges = edges
                        edges = []
                    edges += [(int(names[i]), blocks[i].as_py()) for i in start + np.flatnonzero(new[start:stop])]
                last_mark = marks[stop - 1] if stop > start else last_mark
            count, last_block = int(names[-1]), blocks[batch.num_rows - 1].as_py()
            columns = [batch.column(c) for c in carried]
            columns += [pa.array(base + names, pa.int64()), pa.nulls(batch.num_rows, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*carried, "name", "edge"])
        ends = (first_edges or []) + edges
        if ends:
            columns = [pa.nulls(len(ends), arrow[c]) for c in carried]
            columns += [pa.array([base + n for n, _ in ends], pa.int64()), pa.array([b for _, b in ends], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*carried, "name", "edge"])

    return run


def name_blocks(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` with a binary ``block`` and a ``row`` number: the same without ``block``, with its integer ``name``."""
    spark = rows.sparkSession
    carried = [c for c in rows.columns if c != "block"]
    schema = T.StructType([T.StructField(c, rows.schema[c].dataType) for c in carried] + [T.StructField("name", T.LongType()), T.StructField("edge", T.BinaryType())])
    dealt = (
        rows.withColumn("mark", F.xxhash64("block"))
        .repartitionByRange(spread(spark), "mark", "row")
        .sortWithinPartitions("mark", "block")
    )
    named = materialize(dealt.mapInArrow(_with_names(schema, carried), schema), label)
    edges = named.where("edge IS NOT NULL").select("edge", "name")
    first = edges.groupBy("edge").agg(F.min("name").alias("first_name"))
    renamed = edges.join(first, "edge").where("name <> first_name").select("name", "first_name").distinct()
    return (
        named.where("edge IS NULL")
        .drop("edge")
        .join(renamed, "name", "left")
        .select(*carried, F.coalesce("first_name", "name").alias("name"))
    )


def _pair(left: str, right: str):
    return F.unhex(F.concat(F.lpad(F.hex(left), 16, "0"), F.lpad(F.hex(right), 16, "0")))


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: ``row``, id (bigint), n_chars, digest of the normalised text, and its identity (``level``, ``name``)."""
    data = (
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("id"), text_or_empty(text_col).alias("text"))
        .select("row", "id", F.char_length("text").cast("bigint").alias("n_chars"), F.regexp_replace("text", SPACE, "").cast("binary").alias("data"))
        .withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.octet_length("data") / block_bytes)).cast("bigint"))
    )
    once = {c: F.when(F.col("pos") == 0, v) for c, v in {"id": F.col("id"), "n_chars": F.col("n_chars"), "digest": F.unhex(F.sha2("data", 256))}.items()}
    blocks = data.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_blocks") - 1)).alias("pos")).select(
        "row",
        "pos",
        "n_blocks",
        *(c.alias(n) for n, c in once.items()),
        F.expr(f"substring(data, cast(pos * {block_bytes} + 1 as int), {block_bytes})").alias("block"),
    )
    level0 = materialize(name_blocks(blocks, "blocks"), "names")
    facts = level0.where("pos = 0").select("row", "id", "n_chars", "digest")
    whole = level0.where("n_blocks = 1").select("row", "id", "n_chars", "digest", F.lit(0).alias("level"), "name")
    names, level = level0.where("n_blocks > 1").select("row", "pos", "n_blocks", "name"), 0
    most = names.agg(F.max("n_blocks")).first()[0] or 1
    finished = None
    while most > 1:
        level, most = level + 1, (most + 1) // 2
        side = F.col("pos") % 2
        pairs = names.groupBy("row", F.floor(F.col("pos") / 2).alias("pos"), F.floor((F.col("n_blocks") + 1) / 2).alias("n_blocks")).agg(
            F.max(F.when(side == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(side == 1, F.col("name"))), F.lit(-1)).alias("right"),
        )
        named = materialize(name_blocks(pairs.select("row", "pos", "n_blocks", _pair("left", "right").alias("block")), f"pairs{level}"), f"names{level}")
        done = named.where("n_blocks = 1").select("row", F.lit(level).alias("level"), "name")
        finished = done if finished is None else finished.unionByName(done)
        names = named.where("n_blocks > 1")
    if finished is None:
        return whole
    return whole.unionByName(facts.join(finished, "row").select(*whole.columns))


def decide(found: DataFrame) -> DataFrame:
    """Identities with ``keep_row``, ``keep_id`` and ``group_size``: longest original, then smallest id. Sums before it shuffles."""
    rank = F.coalesce("id", F.lit(NULL_ID))
    by_length = found.groupBy("level", "name", "n_chars").agg(
        F.min_by("row", rank).alias("row"), F.min(rank).alias("rank"), F.count("*").alias("size")
    )
    best = by_length.groupBy("level", "name").agg(
        F.max_by("row", "n_chars").alias("keep_row"), F.max_by("rank", "n_chars").alias("keep_rank"), F.sum("size").alias("group_size")
    )
    keep_id = F.when(F.col("keep_rank") != NULL_ID, F.col("keep_rank"))
    return found.join(best, ["level", "name"]).withColumn("keep_id", keep_id)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns, one row per document."""
    return decide(identities(docs)).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns.

    Rows are found again by id, length and digest, not by a row number, which a second
    reading might deal out differently. Of rows that agree in them the one whose hash is least
    stays.
    """
    key = ["id", "digest", "n_chars"]
    found = decide(identities(docs)).where("row = keep_row")
    marks = found.select(F.coalesce("id", F.lit(NULL_ID)).alias("id"), "digest", "n_chars")
    keyed = wrapped(
        docs,
        id=F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)),
        digest=F.unhex(F.sha2(F.regexp_replace(text_or_empty(), SPACE, "").cast("binary"), 256)),
        n_chars=F.char_length(text_or_empty()).cast("bigint"),
    )
    same = Window.partitionBy(*key).orderBy(F.xxhash64("row"))
    kept = keyed.join(marks, key, "left_semi").withColumn("nth", F.row_number().over(same))
    return unwrapped(kept.where("nth = 1"), docs)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts and the row that stays of each."""
    return digest(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH base AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
)
SELECT doc_id,
  first_value(doc_id) OVER w AS keep_id,
  count(*) OVER (PARTITION BY norm) AS group_size,
  first_value(doc_id) OVER w = doc_id AS kept,
  sha256(norm) AS text_sha256
FROM base
WINDOW w AS (PARTITION BY norm ORDER BY n_chars DESC, doc_id)
"""
