"""Headline queries on the order-shaped interactions; prints one JSON line.

BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs per query after one warm-up; the median counts (default 3)
BENCH_ONLY    comma-separated query names to run alone

"duckdb" holds the seconds of DuckDB for the same stages over the same files on as many
threads, one run each, tables of earlier stages being there before the clock starts. It has
a process, a memory limit and a time limit of its own, and runs after the Spark figures are
on standard error.
"""

from __future__ import annotations

import json
import os
import statistics
import subprocess
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import duckdb  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from marketloom import fixtures as X  # noqa: E402
from marketloom.catalog.oracle import CTES  # noqa: E402
from marketloom.operators import joins as J  # noqa: E402
from marketloom.operators import quality as Q  # noqa: E402
from marketloom.operators import windows as W  # noqa: E402
from marketloom.plans import content, curate, evaluate, features, svd  # noqa: E402
from marketloom.session import build_session, materialize  # noqa: E402

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
ONLY = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
DAY_MICROS = 86_400_000_000


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def build(spark) -> dict:
    """Stage tables are written before the clock starts; each query reads its stage like a job would."""
    raw, profiles, catalog = (
        materialize(view(spark, SF), "raw") for view in (X.raw_order_interactions, X.raw_profiles, X.raw_catalog)
    )
    cur = materialize(curate.curate(raw, profiles, catalog, wide_one_hot=True), "curated")
    products = materialize(features.product_features(cur), "products")
    table = materialize(features.interaction_features(cur), "interactions")
    train, test = evaluate.split(table, "user_id", "product_id", "interaction_date")
    vectors = materialize(content.item_vectors(products), "vectors")
    mine = materialize(content.user_profiles(vectors, train), "profiles")
    recs = materialize(content.recommend(vectors, mine, train, 50), "recs")
    events = X.table(spark, SF, "events")
    views = events.where("event_type = 'view'").select("user_id", "ts", "value")
    purchases = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return {
        "curated_dataset": lambda: noop(curate.curate(raw, profiles, catalog, wide_one_hot=True)),
        "dq_interactions": lambda: noop(Q.suite_report(raw, "user_interactions")),
        "user_features": lambda: noop(features.user_features(cur)),
        "product_features": lambda: noop(features.product_features(cur)),
        "interaction_features": lambda: noop(features.interaction_features(cur)),
        "asof_join": lambda: noop(J.asof_join(purchases, views, ["user_id"], ["value"], DAY_MICROS, "ts", "ts")),
        "content_recommend": lambda: noop(content.recommend(vectors, mine, train, 50)),
        "svd_fit": lambda: svd.fit(train),
        "ranking_metrics": lambda: noop(evaluate.ranking_metrics(recs, test, mine.select("user_id").distinct(), 50)),
        "topn_per_user": lambda: noop(
            W.top_n_per_key(
                raw.groupBy("user_id", "product_id").agg(F.sum("duration_seconds").alias("score")), "user_id", "score", "product_id", 5
            )
        ),
    }


# stage tables in their order, and the query that each belongs to; all-pairs scores are left out
DUCKDB_STAGES = {
    "raw_interactions": "", "raw_profiles": "", "raw_catalog": "",
    "cur_interactions": "curated_dataset", "cur_profiles": "curated_dataset", "cur_catalog": "curated_dataset", "curated": "curated_dataset",
    "user_features": "user_features", "product_features": "product_features", "interaction_features": "interaction_features",
}
DUCKDB_LIMIT = "6GB"
DUCKDB_SECONDS = 240


def duckdb_stages() -> None:
    """Runs in a process of its own; a line of JSON per finished stage, so that an end by force loses only what was not done."""
    con = duckdb.connect()
    con.sql(f"SET threads = {CPUS}")
    con.sql(f"SET memory_limit = '{DUCKDB_LIMIT}'")
    for path in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    for name, query in DUCKDB_STAGES.items():
        start = time.perf_counter()
        con.sql(f"CREATE TABLE {name} AS {CTES['raw_order_interactions' if name == 'raw_interactions' else name][1]}")
        print(json.dumps([query, time.perf_counter() - start]), flush=True)


def duckdb_seconds() -> dict[str, float]:
    out = ""
    try:
        out = subprocess.run([sys.executable, __file__, "--duckdb"], stdout=subprocess.PIPE, text=True, timeout=DUCKDB_SECONDS, check=False).stdout
    except subprocess.TimeoutExpired as stopped:
        out = (stopped.stdout or b"").decode()
    seconds: dict[str, float] = {}
    for query, took in map(json.loads, out.splitlines()):
        if query and (not ONLY or query in ONLY):
            seconds[query] = round(seconds.get(query, 0) + took, 3)
    return seconds


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name, run in build(spark).items():
        if ONLY and name not in ONLY:
            continue
        run()
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            run()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    line = {"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": Path(SF).name}
    # told before anything else runs, so that it cannot be lost
    print("spark", json.dumps(line), file=sys.stderr, flush=True)
    print(json.dumps(line | {"duckdb": duckdb_seconds()}), flush=True)


if __name__ == "__main__":
    duckdb_stages() if sys.argv[1:] == ["--duckdb"] else main()
