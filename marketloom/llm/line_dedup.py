"""Line dedup by counted hashes of runs of lines.

Lines without a visible character are passed over. Of the other lines every run of RUN
counts. Grams of two lines are hashed, and in each window of two grams the least hash is
selected, the first one of ties: any run of RUN lines holds a selected gram at the same
place, wherever it occurs. That is a filter: only runs whose selected gram occurs again
are looked at further. Runs are told apart by a hash of their lines; nothing is extended
or compared line by line. Each run has one first place in the order (id, line), every
later one is marked, and marked runs that touch are joined. Lines under a mark go.

DataFrame functions only. Texts move once, at the end; before that only hashes do.
Counts, first ids and first lines are sums and minima that are formed before a shuffle,
so a passage that a third of all documents hold is no special case.

Defined results: a null text has no lines and stays null; texts of fewer than RUN visible
lines keep all; rows with equal id and text are one document; rows that share only the id
are one place in the order, so neither makes the other later; null ids come last; an
empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketloom.llm.common import table
from marketloom.session import materialize

RUN = 3
LAST_ID = 2**63 - 1


def _lines(text):
    return F.split(text, "\n", -1)


def _keys(docs: DataFrame) -> dict:
    return {"__id": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)), "__mark": F.xxhash64("text")}


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per run: id and mark of its document, number, selected gram, first and last line, hash of its lines.

    Documents are told apart by id and text, not by a row number, which a second reading
    might deal out differently.
    """
    keys = _keys(docs)
    lines = docs.select(keys["__id"].alias("id"), keys["__mark"].alias("mark"), F.explode(F.array(_lines(F.col("text")))).alias("lines"))
    visible = F.filter(
        F.transform("lines", lambda line, i: F.struct(F.when(line.rlike(r"[^\x20\x09-\x0D]"), F.xxhash64(line)).alias("h"), i.alias("at"))),
        lambda line: line["h"].isNotNull(),
    )
    own = lines.select("id", "mark", visible.alias("l")).where(F.size("l") >= RUN)
    grams = F.transform("l", lambda line, i: F.xxhash64(line["h"], F.coalesce(F.get("l", i + 1)["h"], F.lit(0))))
    own = own.select("id", "mark", "l", F.slice(grams, F.lit(1), F.size("l") - 1).alias("g"))
    # run i has the grams i and i + 1
    runs = F.transform(
        F.sequence(F.lit(0), F.size("g") - 2),
        lambda i: F.struct(
            i.alias("i"),
            F.when(F.get("g", i) <= F.get("g", i + 1), i).otherwise(i + 1).alias("gram_at"),
            F.least(F.get("g", i), F.get("g", i + 1)).alias("gram"),
            F.get("l", i)["at"].alias("from_line"),
            F.get("l", i + RUN - 1)["at"].alias("to_line"),
            F.xxhash64(F.get("l", i)["h"], F.get("l", i + 1)["h"], F.get("l", i + 2)["h"]).alias("run"),
        ),
    )
    return own.select("id", "mark", F.explode(runs).alias("r")).select("id", "mark", "r.*")


def later_runs(docs: DataFrame) -> DataFrame:
    """(id, mark, from_line, to_line) of every maximal stretch of runs that occurred earlier."""
    found = materialize(fingerprints(docs), "runs")
    places = found.select("id", "mark", "gram_at", "gram").distinct()
    again = places.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")
    near = found.join(again, "gram")
    in_document = near.groupBy("run", "gram", "id").agg(F.min("i").alias("i"), F.count("*").alias("n"))
    first = in_document.groupBy("run", "gram").agg(F.min_by("i", "id").alias("first_i"), F.min("id").alias("first_id"), F.sum("n").alias("n"))
    later = near.join(first.where("n > 1"), ["run", "gram"]).where("NOT (id = first_id AND i = first_i)")
    order = Window.partitionBy("id", "mark").orderBy("i")
    apart = (F.col("i") > F.lag("i").over(order) + RUN).cast("int")
    stretch = F.sum(F.coalesce(apart, F.lit(0))).over(order)
    marked = later.select("id", "mark", "i", "from_line", "to_line").withColumn("stretch", stretch)
    return marked.groupBy("id", "mark", "stretch").agg(F.min("from_line").alias("from_line"), F.max("to_line").alias("to_line"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """All columns with ``__kept`` (the text without later repeats), ``__n_lines``, ``__n_removed`` and ``__n_stretches``.

    Columns of these four names are replaced; others of any name stay.
    """
    ident, mark, runs, rest = (_free(docs, n) for n in ("id", "mark", "gone", "lines"))
    keys = dict(zip((ident, mark), _keys(docs).values()))
    gone = later_runs(docs).groupBy(F.col("id").alias(ident), F.col("mark").alias(mark)).agg(F.collect_list(F.struct("from_line", "to_line")).alias(runs))
    joined = docs.withColumns(keys).join(gone, list(keys), "left")
    lines = F.transform(_lines(F.col("text")), lambda line, i: F.struct(line.alias("line"), i.alias("i")))
    kept = F.filter(lines, lambda x: (x["line"].rlike(r"[^\x20\x09-\x0D]") == F.lit(False)) | ~F.exists(runs, lambda r: x["i"].between(r["from_line"], r["to_line"])))
    kept = F.transform(kept, lambda x: x["line"])
    joined = joined.withColumn(rest, F.when(F.col(runs).isNotNull(), kept))
    n_lines = F.coalesce(F.size(_lines(F.col("text"))), F.lit(0)).cast("bigint")
    changed = F.col(runs).isNotNull()
    joined = joined.withColumns(
        {
            "__kept": F.when(changed, F.array_join(rest, "\n")).otherwise(F.col("text")),
            "__n_lines": F.when(F.col("text").isNull(), 0).otherwise(n_lines),
            "__n_removed": F.when(changed, n_lines - F.size(rest)).otherwise(0).cast("bigint"),
            "__n_stretches": F.coalesce(F.size(runs), F.lit(0)).cast("bigint"),
        }
    )
    return joined.drop(runs, rest, *keys)


def _free(docs: DataFrame, name: str) -> str:
    """A column name that the input does not have."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines kept and removed of every document, with a digest of the text that stays."""
    rows = without_repeats(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", F.col("__n_lines").cast("bigint").alias("n_lines"), F.col("__n_removed").alias("n_removed"),
        F.sha2(F.coalesce("__kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


ORACLE_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents WHERE text IS NOT NULL
), v AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS i FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), r AS (
  SELECT doc_id, i, line AS a, lead(line) OVER w AS b, lead(line, 2) OVER w AS c FROM v WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), f AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) AS nth FROM r WHERE c IS NOT NULL
), gone AS (
  SELECT DISTINCT doc_id, i + k AS i FROM f, (VALUES (0), (1), (2)) t(k) WHERE nth > 1
), kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.line_no) FILTER (WHERE g.doc_id IS NULL) AS text, count(*) AS n_lines, count(g.doc_id) AS n_removed
  FROM l LEFT JOIN v ON l.doc_id = v.doc_id AND l.line_no = v.line_no LEFT JOIN gone g ON v.doc_id = g.doc_id AND v.i = g.i GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
