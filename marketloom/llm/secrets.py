"""Secret scans by corpus-wide ownership frequency.

Patterns give candidates with their places. The hash of each candidate's value is
counted over the whole corpus by distinct owners and, within them, distinct repositories:
a value that many owners hold is a copied example, one that a single owner holds and that
looks random is a live credential. A private key counts by its body, not by its header,
which all keys of a type share. Spans of the base kinds always stay; the ownership
count decides about the further kinds and marks all of them: a value that looks random
keeps its spans unless it is copied, also with two owners, where it is not called live.

DataFrame functions only. The text is read once: patterns give the matches and the
lengths of the pieces between them, places are running sums over these, and only such
candidate rows are shuffled. Counts are distinct rows first and sums after, so that a
value found in a third of all rows is added up before it moves.

Defined results: a null text is empty and has no spans; a null owner is an owner of its
own; rows are told apart by a row number that is stored with them, so repeated rows
repeat their answer and are one repository; an empty table gives an empty result;
further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketloom.llm.common import table, text_or_empty
from marketloom.session import materialize

# base kinds in the order of the contract (fixed values)
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# further kinds: keys with a public prefix, signed tokens, private keys
PREFIXED = r"(?:gh[opsu]_[A-Za-z0-9]{20,}|glpat-[A-Za-z0-9_-]{20,}|xox[abps]-[A-Za-z0-9-]{10,}|sk_(?:live|test)_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35})"
SIGNED = r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"
# a private key is its header and all up to its END line; without one, the header lines and the base64 block that follow
BREAK = r"(?:\s|\\[nrt])*+"
BLOCK = rf"(?:{BREAK}[A-Z][A-Za-z-]{{2,20}}+:\s?[^\s\\]{{1,80}}+){{0,4}}+(?:{BREAK}[A-Za-z0-9+/=]{{16,}}+)*+(?:{BREAK}[A-Za-z0-9+/]{{1,15}}+={{1,2}})?+"
END_LINE = r"-----END [A-Z ]{0,32}PRIVATE KEY-----"
PRIVATE = rf"-----BEGIN [A-Z ]{{0,32}}PRIVATE KEY-----([^-]*+(?:-{{1,4}}+[^-]++)*+{END_LINE}|{BLOCK})"
# kind: (pattern, group with the value, least length of the value, signs that a text with a match must hold)
KINDS = {
    "assign": (ASSIGN, 2, 6, ("passw", "secret", "token", "api")),
    "access": (ACCESS, 0, 20, ("akia",)),
    "hex": (HEX, 0, 24, ()),
    "prefixed": (PREFIXED, 0, 1, ("gh", "glpat-", "xox", "sk_", "aiza")),
    "signed": (SIGNED, 0, 1, ("eyj",)),
    "private": (PRIVATE, 1, 1, ("private key",)),
}
BASE = ("assign", "access", "hex")
COPIED_OWNERS = 3
LIVE_DISTINCT = 8


def _key(body: Column, whole: Column) -> Column:
    """What tells private keys apart: their base64 signs, however the lines are broken or quoted; a header alone is its own value."""
    signs = F.regexp_replace(body, rf"{END_LINE}|\\[nrt]|[^A-Za-z0-9+/=]", "")
    return F.when(signs != "", signs).otherwise(whole)


def _matches(kind: str) -> Column:
    """Array of (value, match length, length of the piece before it) for every match of a kind."""
    pattern, group, _, signs = KINDS[kind]
    found = F.transform(
        F.arrays_zip(
            F.regexp_extract_all("text", F.lit(pattern), F.lit(group)).alias("value"),
            F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("whole"),
            F.split("text", pattern, -1).alias("piece"),
        ),
        lambda m: F.struct((_key(m["value"], m["whole"]) if kind == "private" else m["value"]).alias("value"), F.char_length(m["whole"]).alias("length"), F.char_length(m["piece"]).alias("before")),
    )
    # the piece after the last match has no match beside it
    found = F.filter(found, lambda m: m["length"].isNotNull())
    if signs:
        here = F.contains(F.col("low"), F.lit(signs[0]))
        for sign in signs[1:]:
            here = here | F.contains(F.col("low"), F.lit(sign))
    else:
        here = F.col("text").rlike(pattern)
    return F.when(here, found)


def candidates(docs: DataFrame, owner_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``row``, id, owner and per kind its matches (null where there are none); stored, without the text."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"),
        F.col(owner_col).isNull().alias("no_owner"), text_or_empty(text_col).alias("text"),
    )
    rows = rows.withColumn("low", F.lower("text"))
    return materialize(rows.select("row", "id", "owner", "no_owner", *(_matches(k).alias(k) for k in KINDS)), "candidates")


def spans(found: DataFrame) -> DataFrame:
    """One row per candidate that is long enough: its kind, start and end in code points, and the hash of its value."""
    each = None
    for place, kind in enumerate(KINDS):
        own = found.where(F.col(kind).isNotNull()).select("row", "id", "owner", "no_owner", F.lit(kind).alias("kind"), F.lit(place).alias("place"), F.posexplode(kind).alias("i", "m"))
        each = own if each is None else each.unionByName(own)
    upto = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("m.before") + F.col("m.length")).over(upto)
    least = F.lit(1)
    for kind in KINDS:
        least = F.when(F.col("kind") == kind, KINDS[kind][2]).otherwise(least)
    value = F.col("m.value")
    out = each.select(
        "row", "id", "owner", "no_owner", "kind", "place", (end - F.col("m.length")).alias("start"), end.alias("end"), F.sha2(value.cast("binary"), 256).alias("mark"),
        F.char_length(value).alias("length"), F.size(F.array_distinct(F.split(value, ""))).alias("signs"),
    )
    return out.where(F.col("length") >= least)


def ownership(each: DataFrame) -> DataFrame:
    """(mark, n_owners, n_repositories) over the whole corpus."""
    own = each.select("mark", "owner", "no_owner", "id").distinct()
    own = own.groupBy("mark", "owner", "no_owner").agg(F.count("*").alias("n"))
    return own.groupBy("mark").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories"))


def scan(docs: DataFrame, owner_col: str = "source", id_col: str = "doc_id", text_col: str = "text", copied_owners: int = COPIED_OWNERS) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): the stored rows, and every span with its ownership counts, ``copied``, ``live`` and ``shared`` (several owners, too few for a copied example)."""
    found = candidates(docs, owner_col, id_col, text_col)
    each = materialize(spans(found), "spans")
    judged = each.join(ownership(each), "mark")
    copied = F.col("n_owners") >= copied_owners
    random = (F.col("signs") >= LIVE_DISTINCT) | (F.col("kind") == "private")
    live = (F.col("n_owners") == 1) & random
    shared = (F.col("n_owners") > 1) & ~copied & random
    return found, judged.withColumns({"copied": copied, "live": live, "shared": shared})


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of every document, with how many of them look live or copied."""
    found, judged = scan(table(spark, sf_dir, "documents"))
    base = F.col("kind").isin(*BASE)
    told = F.struct("start", "place", F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string")).alias("span"))
    joined = lambda spans: F.concat_ws(",", F.transform(F.array_sort(spans), lambda s: s["span"]))
    per_row = (
        judged.where(base | F.col("live") | F.col("shared"))
        .groupBy("row")
        .agg(
            *(F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in BASE),
            F.collect_list(F.when(base, told)).alias("base"),
            F.collect_list(told).alias("every"),
            F.count(F.when(F.col("live"), 1)).alias("n_live"),
            F.count(F.when(F.col("copied"), 1)).alias("n_copied"),
        )
        .select("row", *(f"n_{k}" for k in BASE), joined(F.col("base")).alias("base_text"), joined(F.col("every")).alias("spans"), "n_live", "n_copied")
    )
    out = found.select("row", F.col("id").alias("doc_id")).join(per_row, "row", "left")
    number = {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in (*(f"n_{k}" for k in BASE), "n_live", "n_copied")}
    base_text = F.coalesce("base_text", F.lit(""))
    return out.select(
        "doc_id", *(number[f"n_{k}"].alias(f"n_{k}") for k in BASE), F.sha2(base_text.cast("binary"), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"), number["n_live"].alias("n_live"), number["n_copied"].alias("n_copied"),
    )
