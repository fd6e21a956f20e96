"""Driver-level jobs: ingest, validate, curate and build features for one date."""

from __future__ import annotations

from datetime import UTC, datetime
from datetime import date as Date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketloom.operators import quality, scaling
from marketloom.plans import curate as curation
from marketloom.plans import feature_state
from marketloom.plans import features as feat
from marketloom.schemas import CATALOG, INTERACTIONS, PROFILES
from marketloom.sources import files, listing, snapshots

# fixed values: layout below the data root
RAW = {
    "user_interactions": "raw/batch/user_interactions",
    "user_profiles": "raw/batch/user_profiles",
    "product_catalog": "raw/api",
}
CURATED = "curated"
CATEGORIES = "curated_categories"
FEATURES = "processed/features"
QUALITY = "quality"


def today() -> str:
    return Date.today().strftime("%Y%m%d")


def now() -> str:
    """The time of a run, as audit and event time."""
    return datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S")


def ingest_csv(spark: SparkSession, drop: str, root: str, name: str, date: str | None = None) -> int:
    """Land one dated CSV drop as a Parquet partition; the row count comes with the write."""
    date = date or today()
    schema = {"user_interactions": INTERACTIONS, "user_profiles": PROFILES}[name]
    seen = Observation(f"ingest_{name}")
    df = files.read_drop(spark, drop, date, name, schema).observe(seen, F.count(F.lit(1)).alias("rows"))
    files.write_date(df, f"{root}/{RAW[name]}", date)
    return seen.get["rows"]


def ingest_catalog(spark: SparkSession, source: str, root: str, date: str | None = None) -> None:
    """Land the newest catalog document of ``source`` under the ingestion date."""
    newest = files.latest_source_file(spark, source, "_product_catalog.json")
    if newest is None:
        raise FileNotFoundError(f"no catalog files in {source}")
    products = files.read_catalog_json(spark, f"{source}/{newest}", CATALOG)
    files.write_catalog_json(products, f"{root}/{RAW['product_catalog']}", date or today())


def load_raw(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The newest partition of each raw dataset."""
    catalog_root = f"{root}/{RAW['product_catalog']}"
    newest = listing.latest_partition(spark, catalog_root)
    return {
        "user_interactions": files.read_partition(spark, f"{root}/{RAW['user_interactions']}", schema=INTERACTIONS),
        "user_profiles": files.read_partition(spark, f"{root}/{RAW['user_profiles']}", schema=PROFILES),
        "product_catalog": (
            files.read_catalog_json(spark, f"{catalog_root}/ingestion_date={newest}", CATALOG, lines=True)
        ),
    }


def curate_job(spark: SparkSession, root: str, created_at: str | None = None, **options) -> str:
    """Curate the newest raw partitions into ``event_date=`` and record the lineage.

    Categories stay as text and as arrays of names, and are written once more as (product,
    category) rows: columns per category would limit how many there may be.
    ``wide_one_hot=True`` asks for them.
    """
    created_at = created_at or now()
    raw = load_raw(spark, root)
    days = {n: listing.latest_partition(spark, f"{root}/{p}") for n, p in RAW.items()}
    event_date = days["user_interactions"]
    named = [c for c in ("category", "subcategory") if c in raw["product_catalog"].columns]
    flags = scaling.one_hot_long(raw["product_catalog"].where("product_id IS NOT NULL").dropDuplicates(), "product_id", *named)
    files.write_date(flags, f"{root}/{CATEGORIES}", event_date, "event_date")
    seen = Observation("curate")
    df = curation.curate(raw["user_interactions"], raw["user_profiles"], raw["product_catalog"], **options)
    files.write_date(
        df.observe(seen, F.count(F.lit(1)).alias("rows")), f"{root}/{CURATED}", event_date, "event_date"
    )
    sources = {n: (day, f"{root}/{RAW[n]}/ingestion_date={day}") for n, day in days.items()}
    record = curation.lineage_record(
        spark, event_date, feat.stamp(created_at), sources, df.columns, seen.get["rows"]
    )
    record.write.mode("overwrite").json(f"{root}/lineage/event_date={event_date}")
    return event_date


def content_mark(df: DataFrame) -> str:
    """Row count and order-free hash of all values: tells a corrected date from the same one read again."""
    columns = sorted(df.columns)
    row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*(F.col(f"`{c}`") for c in columns)).cast("decimal(38,0)"))).first()
    return f"{row[0]}:{row[1]}"


def feature_job(
    spark: SparkSession,
    root: str,
    incremental: bool = False,
    date: str | None = None,
    as_of: str | None = None,
) -> bool:
    """Build (or update by one curated partition) the three feature snapshots.

    A full build holds its own date alone. An update adds a date that the current
    version does not hold, older or newer; a date that it holds with the same rows
    changes nothing (False; files that are still the same are not even read); a date that
    it holds with other rows replaces its old contribution, no other date being read.
    """
    as_of = as_of or now()
    curated_root, store = f"{root}/{CURATED}", f"{root}/{FEATURES}"
    day = (date if incremental else None) or listing.latest_partition(spark, curated_root, "event_date")
    read = lambda d: files.read_partition(spark, curated_root, d, "event_date")
    base = snapshots.current(spark, store) if incremental else snapshots.Version()
    batch = f"date:{day}"
    files_now = listing.fingerprint(spark, f"{curated_root}/event_date={day}")
    rows, _, files_then = base.batches.get(batch, "").rpartition("@")
    if files_then == files_now:
        return False
    mark = content_mark(read(day))
    if rows == mark:
        return False
    feature_state.put(spark, store, base, batch, f"{mark}@{files_now}", read(day), as_of, day)
    return True


def data_job(
    spark: SparkSession, drop: str, catalog: str, root: str, date: str | None = None, coerce_first: bool = True, as_of: str | None = None
) -> str:
    """All steps for one date: ingest, quality report and gate, curation, incremental features.

    ``as_of`` (default: the time of the run) becomes audit time everywhere. The report
    is written before the gate may stop the run.
    """
    as_of = as_of or now()
    if date is None:
        newest = files.latest_source_file(spark, drop, "_user_interactions.csv")
        date = newest.split("_")[0] if newest else today()
    for name in ("user_interactions", "user_profiles"):
        ingest_csv(spark, drop, root, name, date)
    ingest_catalog(spark, catalog, root, date)
    raw = load_raw(spark, root)
    for name, df in raw.items():
        report = quality.labelled(quality.suite_report(df, name, coerce_first))
        report.select("line").write.mode("overwrite").text(f"{root}/{QUALITY}/ingestion_date={date}/dataset={name}")
    quality.gate(raw, coerce_first)
    event_date = curate_job(spark, root, as_of)
    feature_job(spark, root, incremental=True, as_of=as_of)
    return event_date
