"""The polling loops and the incremental refresh as Structured Streaming queries."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marketloom.operators.windows import latest_per_key, replace_rows
from marketloom.plans import feature_state
from marketloom.schemas import CATALOG, FEATURE_EPOCH
from marketloom.session import materialize
from marketloom.sources import files, snapshots

POLL = "60 seconds"  # fixed value
PARTS = 64  # of an upserted table without a column to store it by


def _trigger(writer, once: bool, interval: str):
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)


def ingest_stream(
    spark: SparkSession,
    drop: str,
    target: str,
    checkpoint: str,
    schema: T.StructType,
    once: bool = False,
    interval: str = POLL,
) -> StreamingQuery:
    """Land CSV files as they arrive, each exactly once, under the date their name starts with.

    The stream brings file names; each batch reads its files by their headers. A batch has
    its own folder below the date, which a replay overwrites. Names without a date stop
    the query.
    """

    def land(session: SparkSession, date: str, paths: list[str], batch: str) -> None:
        rows = files.read_csv(session, sorted(paths), schema)
        rows.write.mode("overwrite").parquet(f"{target}/ingestion_date={date}/batch={batch}")

    return _poll(spark, drop, "*.csv", checkpoint, land, once, interval)


def catalog_stream(spark: SparkSession, source: str, target: str, checkpoint: str, once: bool = False, interval: str = POLL, lines: bool = False) -> StreamingQuery:
    """Land catalog documents as they arrive; the newest document of a date is what the date's partition holds.

    Of the documents of one batch the one written last counts, then the greater name. A
    replayed batch lands the same documents again. ``lines``: a document has one product per line.
    """

    def land(session: SparkSession, date: str, paths: list[str], batch: str) -> None:
        files.write_catalog_json(files.read_catalog_json(session, paths[-1], CATALOG, lines), target, date)

    return _poll(spark, source, "*_product_catalog.json", checkpoint, land, once, interval)


def _poll(spark: SparkSession, folder: str, pattern: str, checkpoint: str, land: Callable[[SparkSession, str, list[str], str], None], once: bool, interval: str) -> StreamingQuery:
    """Call ``land`` for each date among the files of a batch; the files come in the order in which they were written."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # a name per file of one batch, at most maxFilesPerTrigger
        paths = [r[0] for r in batch.distinct().orderBy("modificationTime", "path").collect()]
        dates = {p: re.match(r"(\d{8})_", p.rsplit("/", 1)[-1]) for p in paths}
        if undated := [p for p, d in dates.items() if not d]:
            raise ValueError(f"no date in the names of {undated}")
        for date in sorted({d[1] for d in dates.values()}):
            land(session, date, [p for p, d in dates.items() if d[1] == date], f"{query_id(session)}-{batch_id}")

    listed = spark.readStream.format("binaryFile").schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
    listed = listed.option("maxFilesPerTrigger", 1000).option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    writer = listed.load(folder).select("path", "modificationTime").writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return _trigger(writer, once, interval).start()


def query_id(session: SparkSession) -> str:
    """Identity of the streaming query whose batch is at hand; it is kept in the query's checkpoint."""
    return session.sparkContext.getLocalProperty("sql.streaming.queryId")


def feature_stream(
    spark: SparkSession,
    curated: DataFrame,
    store: str,
    checkpoint: str,
    as_of=FEATURE_EPOCH,
    once: bool = False,
    interval: str = POLL,
) -> StreamingQuery:
    """Apply each micro-batch of curated rows to the feature snapshots.

    The store keeps the last batch of every query, by the id in the query's checkpoint: a
    batch that was committed before a restart is not added again, and other queries on the
    same store are not confused with it. A new checkpoint is a new query; what it reads
    counts.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        base, name = snapshots.current(session, store), f"query:{query_id(session)}"
        if int(base.batches.get(name, -1)) >= batch_id or batch.isEmpty():
            return
        batch.persist()
        try:
            feature_state.put(session, store, base, name, str(batch_id), batch, as_of, None)
        finally:
            batch.unpersist()

    writer = curated.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return _trigger(writer, once, interval).start()


def upsert_stream(
    spark: SparkSession,
    rows: DataFrame,
    store: str,
    name: str,
    keys: list[str],
    order: list[str],
    checkpoint: str,
    once: bool = False,
    interval: str = POLL,
    part: str | None = None,
) -> StreamingQuery:
    """Keep one row per key: a row of a later batch replaces the stored one.

    The table is stored in parts by ``part``, a column of the key (a date, say), or else by
    a hash of the key; a batch reads and writes only the parts that it has rows for.
    """
    schema = rows.schema
    own = F.col(part).cast("string") if part else F.pmod(F.xxhash64(*keys), F.lit(PARTS)).cast("string")

    def apply(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        base, label = snapshots.current(session, store), f"query:{query_id(session)}"
        if int(base.batches.get(label, -1)) >= batch_id:
            return
        folder, stored = snapshots.next_folder(session, store), base.parts.get(name, {})
        fresh = materialize(latest_per_key(batch, keys, order).withColumn("_part", F.coalesce(own, F.lit("none"))), "upserts")
        # one name per part that the batch touches
        touched = [r[0] for r in fresh.select("_part").distinct().collect()]
        before = snapshots.read_parts(session, store, [stored[p] for p in touched if p in stored], schema)
        before = before.withColumn("_part", F.coalesce(own, F.lit("none")))
        written = snapshots.write_by(replace_rows(before, fresh, keys), store, folder, name, "_part") if touched else {}
        snapshots.commit(session, store, folder, base.parts | {name: stored | written}, base.batches | {label: str(batch_id)})

    writer = rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return _trigger(writer, once, interval).start()
