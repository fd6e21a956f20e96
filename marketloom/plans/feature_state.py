"""Feature tables as state that grows by batches and lets a batch be replaced.

Users and products: every batch (a curated date, or a micro-batch of a stream) leaves its
partial aggregates as a part of its own. The features are a merge of the partials in the
order of their sequence: dates by date, streamed batches behind them as they came. A batch
that comes again with other rows has its part replaced; no other batch is read. Dates of a
month that is over are compacted into one part per month, from their partials, which stay;
streamed parts are compacted by levels of FAN, and the compacted ones go.

Interactions: every batch leaves its rows by interaction date, and the live table has one
folder per date: that of its only batch, or one in which the last batch that has a
(user, product, date) won. Only dates that a batch touches are written again.

So an update reads and writes in proportion to its batch, apart from the compaction of a
month, and a reader merges a bounded number of parts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.operators import aggregates as A
from marketloom.operators import cleaning as C
from marketloom.operators import windows as W
from marketloom.plans import features as feat
from marketloom.schemas import INTERACTION_FEATURES, PRODUCT_FEATURES, USER_FEATURES
from marketloom.session import materialize
from marketloom.sources import snapshots

FAN = 8
SEQ = "_seq"
DAY = "_day"
KEYS = ["user_id", "product_id", "interaction_date"]
LIVE, DAYS = "interaction_features", "interaction_days"
STREAM = 1_000_000_000  # sequence numbers of streamed batches start here, behind all dates


@dataclass(frozen=True)
class Merged:
    """A table that is merged from partials: its key, columns and rules."""

    key: str
    schema: T.StructType
    build: Callable[[DataFrame], DataFrame]
    rules: dict[str, str]

    def stored(self) -> T.StructType:
        """Columns of a partial: those of the rules in the types of the finished table."""
        kinds = {f.name: f.dataType for f in self.schema} | {"purchases": T.LongType()}
        return T.StructType([T.StructField(c, kinds[c]) for c in (self.key, *self.rules)] + [T.StructField(SEQ, T.LongType())])

    def partial(self, df: DataFrame, as_of, seq: int) -> DataFrame:
        made = C.with_audit(self.build(df), feat.stamp(as_of))
        known = [F.col(f.name).cast(f.dataType) if f.name in made.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in self.stored()[:-1]]
        return made.select(*known, F.lit(seq).cast("bigint").alias(SEQ))

    def merge(self, parts: DataFrame) -> DataFrame:
        return A.rule_aggregate(parts, self.key, {**self.rules, SEQ: "max"}, SEQ)


# created with the first partial, updated by the last one written
_STAMPS = {"created_at": "min", "updated_at": "max"}
USERS = Merged("user_id", USER_FEATURES, feat.user_aggregates, feat.USER_RULES | _STAMPS)
PRODUCTS = Merged("product_id", PRODUCT_FEATURES, feat.product_aggregates, feat.PRODUCT_RULES | _STAMPS)
MERGED = {"user_features": USERS, "product_features": PRODUCTS}
SCHEMAS = {"user_features": USER_FEATURES, "product_features": PRODUCT_FEATURES, LIVE: INTERACTION_FEATURES}


def live_parts(parts: dict[str, str]) -> dict[str, str]:
    """The parts that a merge reads: a compacted month stands for its dates."""
    months = {p[1:] for p in parts if p.startswith("m")}
    return {p: f for p, f in parts.items() if not (p.isdigit() and p[:6] in months)}


def load(spark: SparkSession, store: str, name: str, version: snapshots.Version | None = None) -> DataFrame:
    """The finished feature table of a version (default: the current one)."""
    version = version or snapshots.current(spark, store)
    if name == LIVE:
        return snapshots.read_parts(spark, store, version.parts.get(LIVE, {}).values(), INTERACTION_FEATURES)
    table = MERGED[name]
    parts = snapshots.read_parts(spark, store, live_parts(version.parts.get(name, {})).values(), table.stored())
    merged = table.merge(parts).drop(SEQ)
    if name == "user_features":
        return feat.finish_users(merged)
    return feat.finish_products(merged, parts.groupBy("product_id").agg(F.sum("interaction_count").alias("interaction_count")))


class _Change:
    """The next version while it is written."""

    def __init__(self, spark: SparkSession, store: str, base: snapshots.Version):
        self.spark, self.store = spark, store
        self.folder = snapshots.next_folder(spark, store)
        self.parts = {n: dict(own) for n, own in base.parts.items()}
        self.batches = dict(base.batches)

    def of(self, name: str) -> dict[str, str]:
        return self.parts.setdefault(name, {})

    def read(self, name: str, wanted: list[str], schema: T.StructType) -> DataFrame:
        return snapshots.read_parts(self.spark, self.store, [self.of(name)[p] for p in wanted], schema)

    def write(self, name: str, part: str, df: DataFrame) -> None:
        df.write.parquet(f"{self.store}/{self.folder}/{name}/part={part}")
        self.of(name)[part] = f"{self.folder}/{name}/part={part}"


def put(spark: SparkSession, store: str, base: snapshots.Version, label: str, mark: str, df: DataFrame, as_of, date: str | None) -> int:
    """Commit a version with ``df`` as the rows of batch ``label``, in the place of those it had.

    ``date`` is the batch's date; without one the batch is streamed, and adds to those before it.
    """
    change = _Change(spark, store, base)
    seq = int(date) if date else STREAM + int(change.folder[2:])
    for name, table in MERGED.items():
        change.write(name, date or f"s0-{seq}", table.partial(df, as_of, seq))
        if date:
            _compact_months(change, name, table, date)
        else:
            _compact_streamed(change, name, table)
    _put_interactions(change, materialize(feat.interaction_features(df, as_of), "interactions"), date, seq)
    change.batches[label] = mark
    return snapshots.commit(spark, store, change.folder, change.parts, change.batches)


def _compact_months(change: _Change, name: str, table: Merged, touched: str) -> None:
    """One part per month that is over: the touched one is made again, one that has just ended for the first time."""
    own = change.of(name)
    dates = sorted(p for p in own if p.isdigit())
    months = {d[:6]: [x for x in dates if x[:6] == d[:6]] for d in dates}
    for month, days in months.items():
        stale = month == touched[:6] or f"m{month}" not in own
        if month < max(months) and len(days) > 1 and stale:
            change.write(name, f"m{month}", table.merge(change.read(name, days, table.stored())))


def _compact_streamed(change: _Change, name: str, table: Merged) -> None:
    """FAN parts of a level become one of the next; what a level holds is newer than all levels above."""
    level = 0
    while True:
        own = change.of(name)
        full = sorted(p for p in own if p.startswith(f"s{level}-"))
        if len(full) < FAN:
            return
        seq = max(int(p.split("-")[1]) for p in full)
        merged = table.merge(change.read(name, full, table.stored()))
        change.write(name, f"s{level + 1}-{seq}", merged)
        for p in full:
            del own[p]
        level += 1


def _put_interactions(change: _Change, fresh: DataFrame, date: str | None, seq: int) -> None:
    """Replace the batch's rows by date, then the live folders of the dates that it has or had."""
    days, live = change.of(DAYS), change.of(LIVE)
    batch = date or "s"
    tagged = fresh.withColumns({SEQ: F.lit(seq).cast("bigint"), DAY: F.date_format("interaction_date", "yyyyMMdd")})
    if not date:
        # all that was streamed for a date is one folder
        new = [r[0] for r in tagged.select(DAY).distinct().collect()]
        before = change.read(DAYS, [p for p in (f"s|{d}" for d in new) if p in days], _stored_days())
        tagged = newest(tagged.unionByName(before.withColumn(DAY, F.date_format("interaction_date", "yyyyMMdd"))))
    had = [p for p in days if p.startswith(f"{batch}|")] if date else []
    written = snapshots.write_by(tagged, change.store, change.folder, DAYS, DAY)
    for p in had:
        del days[p]
    days |= {f"{batch}|{d}": f for d, f in written.items()}
    touched = {p.split("|")[1] for p in had} | set(written)
    by_day: dict[str, list[str]] = {d: [] for d in touched}
    for p in days:
        if (day := p.split("|")[1]) in touched:
            by_day[day].append(p)
    for day, own in by_day.items():
        live.pop(day, None)
        if len(own) == 1:
            live[day] = days[own[0]]
    shared = [p for own in by_day.values() if len(own) > 1 for p in own]
    if shared:
        rows = newest(change.read(DAYS, shared, _stored_days())).withColumn(DAY, F.date_format("interaction_date", "yyyyMMdd"))
        live |= snapshots.write_by(rows, change.store, change.folder, LIVE, DAY)


def _stored_days() -> T.StructType:
    return T.StructType([*INTERACTION_FEATURES.fields, T.StructField(SEQ, T.LongType())])


def newest(rows: DataFrame) -> DataFrame:
    """The row of the last batch per (user, product, date). A batch has a key once, so the number of the last one finds its row."""
    last = rows.groupBy(*KEYS).agg(F.max(SEQ).alias(SEQ))
    return rows.join(last, [*KEYS, SEQ], "left_semi")


def published_schema(name: str) -> T.StructType:
    """Columns of a published table: ids as text, and the event time."""
    text = {"user_id", "product_id"}
    kept = [T.StructField(f.name, T.StringType()) if f.name in text else f for f in SCHEMAS[name]]
    return T.StructType([*kept, T.StructField("event_timestamp", T.TimestampType())])


def publish(spark: SparkSession, store: str, target: str, as_of) -> int | None:
    """Write the finished tables with event times and text ids as one more version of ``target``, as feature views read them.

    Users and products count from ``as_of`` on; an interaction happened when its batch was
    applied. All versions stay, so that earlier events find the features of their time. A
    state that is published already is not written again (None).
    """
    version = snapshots.current(spark, store)
    mark = {"state": str(version.number)}
    if not version.number or snapshots.held_batches(spark, target) == mark:
        return None
    tables = {}
    for name in SCHEMAS:
        at = F.col("created_at") if name == LIVE else as_of
        tables[name] = feat.with_event_time(load(spark, store, name, version), at)
    return snapshots.save_snapshots(spark, target, tables, mark, keep=None)
