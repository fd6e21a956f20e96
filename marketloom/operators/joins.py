"""Equi-joins with suffixes, point-in-time joins and key lookups.

None of the joins forces a broadcast: Spark broadcasts a side only when its
known size is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts
and merges, where adaptive execution splits a key that holds a large share of
the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.operators.windows import latest_per_key
from marketloom.schemas import FeatureView
from marketloom.session import materialize


def left_join(left: DataFrame, right: DataFrame, on: str, suffix: str) -> DataFrame:
    """Left outer join; right columns that exist on the left get ``suffix``."""
    clashes = {c: f"{c}{suffix}" for c in right.columns if c in left.columns and c != on}
    return left.join(right.withColumnsRenamed(clashes), on, "left")


def semi_join(left: DataFrame, right: DataFrame, *on: str) -> DataFrame:
    return left.join(right.select(*on), list(on), "left_semi")


def anti_join(left: DataFrame, right: DataFrame, *on: str) -> DataFrame:
    return left.join(right.select(*on), list(on), "left_anti")


def realign_to_keys(keys: DataFrame, partial: DataFrame, on: str, *measures: str) -> DataFrame:
    """One row per key; measures of keys without a partial result are 0."""
    joined = keys.select(on).distinct().join(partial, on, "left")
    return joined.withColumns({m: F.coalesce(F.col(m), F.lit(0)) for m in measures})


def _carry_facts(keys: int):
    """A task function over rows sorted by (keys, time, kind): probes come out with the newest fact before them.

    ``hit`` is that fact if the partition has it; ``open`` says that the key may have come
    from the partition before. One more row per partition holds its last key and that key's
    newest fact (``last`` is true). Nested functions ship by value.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow.compute as pc

        part = TaskContext.get().partitionId()
        head, carry, first = None, None, True  # last key, its newest fact, whether it is the partition's first key
        names = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            own = [batch.column(i) for i in range(keys)]
            new = np.zeros(n, bool)
            for c in own:
                # null keys have no facts, so nothing depends on whether they are equal
                new[1:] |= pc.fill_null(pc.not_equal(c.slice(1), c.slice(0, n - 1)), True).to_numpy(zero_copy_only=False)
            now = [c[0].as_py() for c in own]
            new[0] = head is not None and now != head
            at = np.arange(n)
            kind, facts, rows = batch.column("_kind").to_numpy(), batch.column("_fact"), batch.column("_row")
            newest = np.maximum.accumulate(np.where(kind == 0, at, -1))
            start = np.maximum.accumulate(np.where(new, at, -1))  # -1: the key of the batch before
            pool = pa.concat_arrays([carry if carry is not None else pa.nulls(1, facts.type), facts])
            known = (newest >= 0) & (newest >= start)
            # place 0 of the pool is what the batch before carries over
            index = np.where(known, newest + 1, 0)
            missing = ~known & ((start >= 0) | (carry is None))
            opened = missing & (np.cumsum(new) == 0) & first
            take = pa.array(index, mask=missing)
            probes = np.flatnonzero(kind == 1)
            names = names or [*batch.schema.names[:keys], "_row", "_hit", "_open", "_part", "_last"]
            yield pa.RecordBatch.from_arrays(
                [*(c.take(pa.array(probes)) for c in own), rows.take(pa.array(probes)), pool.take(take).take(pa.array(probes)), pa.array(opened[probes]), pa.array(np.full(len(probes), part)), pa.array(np.zeros(len(probes), bool))],
                names=names,
            )
            first &= not new.any()
            head = [c[n - 1].as_py() for c in own]
            carry = None if missing[-1] else pool.take(pa.array([index[-1]]))
            edge = [*(c.slice(n - 1) for c in own), pa.nulls(1, rows.type), carry if carry is not None else pa.nulls(1, facts.type)]
        if names:
            yield pa.RecordBatch.from_arrays([*edge, pa.array([False]), pa.array([part]), pa.array([True])], names=names)

    return run


def asof_join(
    entities: DataFrame,
    features: DataFrame,
    keys: list[str],
    values: list[str],
    ttl_micros: int,
    entity_ts: str = "event_timestamp",
    feature_ts: str = "event_timestamp",
) -> DataFrame:
    """Newest feature row at or before each entity row and not older than the TTL.

    Adds ``values`` and ``feature_timestamp`` (null without a match). A feature at
    the same instant as the entity matches. Feature rows of one key with equal
    times resolve to the largest values. Entities with a null key or time match nothing.

    Both sides are scanned once and meet in one range sort by (key, time), so one key may
    own all rows: its rows spread over as many partitions as they fill. A pass over each
    partition carries the newest feature along, in Arrow batches. A key that goes on from
    the partition before takes over what that one ends with, from a table of one row per
    partition.
    """

    def micros(column: str) -> Column:
        return F.unix_micros(F.col(f"`{column}`").cast("timestamp"))

    names = [f"_k{i}" for i in range(len(keys))]
    own = [F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)]
    row = F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(entities.columns)))
    fact = F.struct(micros(feature_ts).alias("at"), *(F.col(f"`{v}`").alias(f"v{i}") for i, v in enumerate(values)))
    facts = features.select(*own, micros(feature_ts).alias("_us"), F.lit(0).alias("_kind"), fact.alias("_fact"))
    facts = facts.where(" AND ".join(f"{c} IS NOT NULL" for c in [*names, "_us"]))
    probes = entities.select(*own, micros(entity_ts).alias("_us"), F.lit(1).alias("_kind"), row.alias("_row"))
    both = facts.unionByName(probes, allowMissingColumns=True)
    # rows of one key and time spread by their hash
    order = [*names, "_us", "_kind", "_fact", F.xxhash64("_row")]
    both = both.repartitionByRange(*order).sortWithinPartitions(*order)
    kinds = {f.name: f.dataType for f in both.schema}
    schema = T.StructType(
        [T.StructField(n, kinds[n]) for n in (*names, "_row")]
        + [T.StructField("_hit", kinds["_fact"]), T.StructField("_open", T.BooleanType()), T.StructField("_part", T.LongType()), T.StructField("_last", T.BooleanType())]
    )
    found = materialize(both.mapInArrow(_carry_facts(len(names)), schema), "asof")
    # one row per partition of the sort: a size that is known, whatever the data
    along = Window.partitionBy(*names).orderBy("_part")
    edges = found.where("_last").select(
        *(F.col(n).alias(f"_of{n}") for n in names), F.last("_hit", ignorenulls=True).over(along).alias("_before"), F.lead("_part").over(Window.orderBy("_part")).alias("_next")
    )
    same = [F.col(n).eqNullSafe(F.col(f"_of{n}")) for n in names]
    resolved = found.where("NOT _last").join(edges, reduce(lambda x, y: x & y, [F.col("_part") == F.col("_next"), F.col("_open"), *same]), "left")
    hit = resolved.select(F.col("_row"), micros_of(entities, entity_ts).alias("_us"), F.coalesce("_hit", "_before").alias("_hit"))
    fresh = hit.withColumn("_hit", F.when(F.col("_us") - F.col("_hit.at") <= ttl_micros, F.col("_hit")))
    kept = {c: F.col(f"_row.c{i}") for i, c in enumerate(entities.columns)}
    kept |= {v: F.col(f"_hit.v{i}") for i, v in enumerate(values)} | {"feature_timestamp": F.timestamp_micros(F.col("_hit.at"))}
    return fresh.select(*(c.alias(n) for n, c in kept.items()))


def micros_of(entities: DataFrame, column: str) -> Column:
    """Time of a packed entity row."""
    return F.unix_micros(F.col(f"_row.c{entities.columns.index(column)}").cast("timestamp"))


def view_columns(view: FeatureView, wanted: list[str] | None = None) -> list[Column]:
    """The typed feature columns of a view, in declared order."""
    names = wanted if wanted is not None else view.features
    return [F.col(n).cast(view.schema[n].dataType).alias(n) for n in names]


def project_view(df: DataFrame, view: FeatureView) -> DataFrame:
    return df.select(*view.keys, view.timestamp, *view_columns(view))


def snapshot_join(
    entities: DataFrame,
    features: DataFrame,
    view: FeatureView,
    wanted: list[str] | None = None,
    entity_ts: str = "event_timestamp",
) -> DataFrame:
    """Point-in-time join for a view that holds one row per key (a single snapshot).

    With one candidate per key the search reduces to an equi-join and a range
    test, so no window is needed. Features whose name the entity frame already
    has are prefixed ``view__``.
    """
    names = wanted if wanted is not None else view.features
    right = features.select(
        *view.keys,
        F.col(view.timestamp).cast("timestamp").alias("_feature_ts"),
        F.struct(*view_columns(view, names)).alias("_f"),
    )
    age = F.unix_micros(F.col(entity_ts).cast("timestamp")) - F.unix_micros("_feature_ts")
    valid = age.between(0, view.ttl_days * 86_400_000_000)
    joined = entities.join(right, list(view.keys), "left")
    return joined.withColumns(
        {
            (f"{view.name}__{n}" if n in entities.columns else n): F.when(valid, F.col(f"_f.{n}"))
            for n in names
        }
    ).drop("_feature_ts", "_f")


def online_lookup(keys: DataFrame, features: DataFrame, view: FeatureView, wanted: list[str]) -> DataFrame:
    """Latest feature values for the given keys; null for an unknown key. Only the wanted keys' rows are compared."""
    asked = features.join(keys.select(*view.keys).distinct(), list(view.keys), "left_semi")
    rows = asked.select(*view.keys, view.timestamp, *view_columns(view, wanted))
    latest = latest_per_key(rows, list(view.keys), [view.timestamp]).drop(view.timestamp)
    return keys.join(latest, list(view.keys), "left").select(*keys.columns, *wanted)


def validity(history: DataFrame, view: FeatureView) -> DataFrame:
    """Rows of successive snapshots with the time in which each counts: ``valid_from`` (included) to ``valid_to`` (excluded, null: open).

    A key's row counts until the next snapshot that has the key, or to the end of the view's
    time to live. A snapshot that has the same features again adds no interval.
    """
    rows = history.select(*view.keys, F.col(view.timestamp).cast("timestamp").alias("valid_from"), F.struct(*view_columns(view)).alias("_f"))
    own = Window.partitionBy(*view.keys).orderBy("valid_from")
    changed = rows.withColumn("_before", F.lag("_f").over(own)).where("_before IS NULL OR NOT (_before <=> _f)").drop("_before")
    return changed.withColumn("valid_to", F.lead("valid_from").over(own)).select(*view.keys, "valid_from", "valid_to", "_f.*")


def history_join(entities: DataFrame, history: DataFrame, view: FeatureView, wanted: list[str] | None = None, entity_ts: str = "event_timestamp") -> DataFrame:
    """Point-in-time join with all snapshots of a view: each row gets the features that counted at its time.

    Features whose name the entity frame already has are prefixed ``view__``.
    """
    names = wanted if wanted is not None else view.features
    rows = history.select(*view.keys, view.timestamp, *view_columns(view, names)).withColumnsRenamed({n: f"_f_{n}" for n in names})
    found = asof_join(entities, rows, list(view.keys), [f"_f_{n}" for n in names], view.ttl_days * 86_400_000_000, entity_ts, view.timestamp)
    return found.drop("feature_timestamp").withColumnsRenamed({f"_f_{n}": f"{view.name}__{n}" if n in entities.columns else n for n in names})
