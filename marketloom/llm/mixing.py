"""Mixing sources to target weights with a hypergeometric splitting tree.

Sizes are words. Weights share ``share`` times all sizes among the sources; a source
stops at ``cap`` times its own size and the excess is reshared by weight until none is
above. A source whose target reaches its size gives every document once, and the rest is
its quota of extra words. The quota goes down a binary tree over the output shards: at
each node the left half gets a hypergeometric share of the words asked for, given what
either half holds (drawn from the normal law of that mean and variance, rounded, and
kept inside what both halves can give), so quotas stay exact at every level. In a leaf,
one source in one shard, documents are permuted and taken until the quota is met; the
last one counts in part (as a document it is taken whole from its half on). Draws and permutations come from hashes of (seed, place), so
reruns agree. Shards have a bounded number of words: the tree is deeper for more data,
and a source that holds a third of all rows is spread over all shards.

Defined results: null texts and ids are counted like any others (size 0 for a null
text), null is a source of its own and the last one; a source without words has target
0; repeated rows are documents of their own; an empty table gives an empty result;
further columns of any name pass through ``mixed_documents``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketloom.llm.common import WORD, table, text_or_empty, unwrapped, wrapped
from marketloom.operators.windows import sorted_positions
from marketloom.session import materialize

WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2.0
SHARD_WORDS = 4_000_000
SLOT_BITS = 20
SEED = 20240517


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def _uniform(*parts) -> Column:
    """A number in (0, 1) from a hash of the parts."""
    return (F.pmod(F.xxhash64(F.lit(SEED), *parts), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, number, source_size, target) from (source, source_size); only sums come to the driver."""
    named = sizes.where("source IS NOT NULL")
    ranked = sorted_positions(named, "source")
    unnamed = sizes.where("source IS NULL").withColumn("position", F.lit(ranked.count()))
    ranked = ranked.unionByName(unnamed)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("position") % len(weights) + 1).cast("int"))
    ranked = materialize(ranked.withColumn("weight", weight.cast("double")), "sources")
    total = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    level, before = (share * (total[0] or 0) / total[1] if total[1] else 0.0), -1
    while True:
        above = F.col("weight") * level > cap * F.col("source_size")
        n, held, free = ranked.agg(
            F.count(F.when(above, 1)), F.coalesce(F.sum(F.when(above, cap * F.col("source_size"))), F.lit(0.0)), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if n == before or not free:
            break
        level, before = (share * total[0] - held) / free, n
    target = F.least(F.col("weight") * level, cap * F.col("source_size"))
    return ranked.select("source", F.col("position").alias("number"), "source_size", target.alias("target"))


def split_quotas(quotas: DataFrame, held: DataFrame, depth: int) -> DataFrame:
    """(number, shard, quota) for the 2**depth shards from (number, quota) and the words that shards hold, (number, shard, held)."""
    now = quotas.select("number", F.lit(0).cast("bigint").alias("node"), "quota")
    for level in range(1, depth + 1):
        child = F.shiftright("shard", depth - level)
        even = child % 2 == 0
        halves = held.groupBy("number", F.shiftright(child, 1).alias("node")).agg(
            F.sum(F.when(even, F.col("held")).otherwise(0)).alias("left"), F.sum(F.when(~even, F.col("held")).otherwise(0)).alias("right")
        )
        k, a, b = (F.col(c).cast("double") for c in ("quota", "left", "right"))
        n = a + b
        spread = F.sqrt(F.greatest(F.lit(0.0), k * (a / n) * (b / n) * (n - k) / F.greatest(n - 1, F.lit(1.0))))
        place = [F.lit(level), F.col("number"), F.col("node")]
        normal = F.sqrt(-2 * F.log(_uniform(*place, F.lit("radius")))) * F.cos(2 * math.pi * _uniform(*place, F.lit("angle")))
        drawn = F.round(k * a / n + spread * normal).cast("bigint")
        drawn = F.least(F.greatest(drawn, F.col("quota") - F.col("right"), F.lit(0).cast("bigint")), "quota", "left")
        both = now.join(halves.where("left + right > 0"), ["number", "node"]).withColumn("drawn", drawn)
        sides = F.array(F.struct((F.col("node") * 2).alias("node"), F.col("drawn").alias("quota")), F.struct((F.col("node") * 2 + 1).alias("node"), (F.col("quota") - F.col("drawn")).alias("quota")))
        now = both.select("number", F.explode(sides).alias("side")).select("number", "side.node", "side.quota").where("quota > 0")
    return now.select("number", F.col("node").alias("shard"), "quota")


def mix(
    rows: DataFrame, size: Column, source_col: str = "source", id_col: str = "doc_id", shard_words: int = SHARD_WORDS, text_mark: Column | None = None, **weighing
) -> DataFrame:
    """The rows with what the mix takes of each: ``__mix_size``, ``_source_size``, ``_target``, ``_taken``, ``_shard`` and ``_order``.

    Sorting a shard by ``__mix_order`` is its local shuffle. ``text_mark``, a hash of the text,
    tells rows apart that have no ids of their own. Columns that begin with ``__mix_`` are replaced.
    """
    sized = rows.drop(*(c for c in rows.columns if c.startswith("__mix_"))).withColumns({"__mix_size": size, "__mix_text": F.lit(0) if text_mark is None else text_mark})
    own = [F.lit(SEED), F.col(id_col).cast("string"), F.col("__mix_size"), F.col("__mix_text")]
    mark = F.xxhash64(*own, F.lit("shard"))
    # counted once per (source, slot); how many shards there are follows from the sum
    slots = 1 << SLOT_BITS
    by_slot = sized.groupBy(F.col(source_col).alias("source"), F.pmod(mark, F.lit(slots)).alias("slot")).agg(F.sum("__mix_size").alias("held"))
    by_slot = materialize(by_slot, "held")
    total = by_slot.agg(F.sum("held")).first()[0] or 0
    depth = min(SLOT_BITS, max(0, math.ceil(math.log2(max(1, total / shard_words)))))
    targets = source_targets(by_slot.groupBy("source").agg(F.sum("held").alias("source_size")), **weighing)
    asked = F.least(F.round("target").cast("bigint"), 2 * F.col("source_size"))
    once = (asked >= F.col("source_size")).cast("int")
    targets = materialize(targets.select("*", once.alias("once"), (asked - once * F.col("source_size")).alias("quota")), "targets")
    shard = F.shiftright(F.pmod(mark, F.lit(slots)), SLOT_BITS - depth)
    held = by_slot.join(targets, by_slot["source"].eqNullSafe(targets["source"]))
    held = held.groupBy("number", F.shiftright("slot", SLOT_BITS - depth).alias("shard")).agg(F.sum("held").alias("held"))
    quotas = materialize(split_quotas(targets.where("quota > 0").select("number", "quota"), held, depth), "quotas")
    facts = targets.select(*(F.col(c).alias(f"__mix_{c}") for c in ("source", "number", "source_size", "target", "once")))
    dealt = sized.withColumns({"__mix_shard": shard, "__mix_order": F.xxhash64(*own, F.lit("order"))})
    dealt = dealt.join(facts, F.col(source_col).eqNullSafe(F.col("__mix_source")))
    quotas = quotas.select(F.col("number").alias("__mix_number"), F.col("shard").alias("__mix_shard"), F.col("quota").alias("__mix_quota"))
    dealt = dealt.join(quotas, ["__mix_number", "__mix_shard"], "left")
    leaf = Window.partitionBy("__mix_number", "__mix_shard").orderBy("__mix_order", id_col, "__mix_size", "__mix_text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = F.coalesce("__mix_quota", F.lit(0)) - (F.sum("__mix_size").over(leaf) - F.col("__mix_size"))
    extra = F.greatest(F.lit(0), F.least("__mix_size", left))
    taken = (F.col("__mix_once") * F.col("__mix_size") + extra).cast("bigint")
    return dealt.withColumn("__mix_taken", taken).drop("__mix_source", "__mix_number", "__mix_once", "__mix_quota", "__mix_text")


def mixed_documents(docs: DataFrame, **weighing) -> DataFrame:
    """The mix as documents, whole ones only: each as often as it is taken, a part of one counting once from its half on."""
    rows = wrapped(docs, doc_id=F.col("doc_id"), source=F.col("source"), size=words(text_or_empty()), text_mark=F.xxhash64("text"))
    dealt = mix(rows, F.col("size"), text_mark=F.col("text_mark"), **weighing)
    copies = F.when(F.col("size") > 0, F.round(F.col("__mix_taken") / F.col("size"))).otherwise(1).cast("int")
    return unwrapped(dealt.withColumn("copy", F.explode(F.array_repeat(F.lit(0), copies))), docs)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    docs = table(spark, sf_dir, "documents")
    sizes = materialize(docs.select("doc_id", "source", words(text_or_empty()).alias("size"), F.xxhash64("text").alias("text_mark")), "sizes")
    return mix(sizes, F.col("size"), text_mark=F.col("text_mark")).select(
        "doc_id", "size", F.col("__mix_source_size").alias("source_size"), F.col("__mix_target").alias("target"), F.col("__mix_taken").alias("taken"),
        F.col("__mix_shard").alias("shard"), F.col("__mix_order").alias("shard_order"),
    )
