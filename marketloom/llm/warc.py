"""WARC records with a Merkle fixity audit.

Pages become WARC response records in shards of bounded size, ordered by page id, each
with its offset and length in the shard and a digest of its bytes. A replica is a folder
of compressed WARC files; it is read back file by file, records being cut by their stated
length. Over the ordered records of a shard stands a tree: a node hashes up to FANOUT
children together with the offset range that they cover. An audit compares the roots of
two replicas and goes down only where they differ; below the lowest differing nodes the
records are matched by id, which tells damaged, missing, added and moved ones apart.

Offsets are sums within a shard and nodes hold at most FANOUT hashes, so nothing is
gathered beyond one shard; the places of the records come from a range sort.

Defined results: a null url or html is empty; a null id is written as an empty id and
comes first; records with equal ids are ordered by their digests and matched in that
order; a file that can't be decompressed or parsed gives the records before the break,
the rest is missing; an empty table has no shards; further columns are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketloom.llm.common import spread, table
from marketloom.operators.windows import sorted_positions
from marketloom.session import materialize, scratch_path

SHARD_RECORDS = 1024
FANOUT = 16
# fixed values of the format
END = "\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"
LENGTH = re.compile(rb"\r\ncontent-length:\s*(\d+)", re.I)
RECORD_ID = re.compile(rb"\r\nWARC-Record-ID: <urn:page:(-?\d*):([0-9a-f]*)>")


def record_text(page_id: Column, url: Column, html: Column, digest: Column) -> Column:
    """A whole record without its closing blank lines."""
    ident = F.coalesce(page_id.cast("string"), F.lit(""))
    head = [
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), ident, F.lit(":"), digest, F.lit(">\r\nWARC-Date: " + DATE + "\r\nWARC-Target-URI: "),
        F.regexp_replace(url, "[\r\n]", " "), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit(END),
    ]
    return F.concat(*head, html)


def parts(pages: DataFrame) -> DataFrame:
    """(page_id, url, html) without null texts."""
    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), *(F.coalesce(c, F.lit("")).alias(c) for c in ("url", "html")))


def payload() -> Column:
    """Digest of the html, part of the record id."""
    return F.substring(F.sha2(F.col("html").cast("binary"), 256), 1, 32)


def record() -> Column:
    return record_text(F.col("page_id"), F.col("url"), F.col("html"), payload())


def records(pages: DataFrame) -> DataFrame:
    """The pages with ``payload`` and ``record``, its text."""
    return parts(pages).select("page_id", payload().alias("payload"), record().alias("record"))


def index(made: DataFrame, shard_records: int = SHARD_RECORDS) -> DataFrame:
    """(page_id, payload, shard, ordinal, offset, length, digest) of the records in their order; stored."""
    facts = made.select("page_id", "payload", F.octet_length("record").cast("bigint").alias("length"), F.sha2(F.col("record").cast("binary"), 256).alias("digest"))
    placed = sorted_positions(facts, "page_id", "payload", "digest").select(
        "*", F.floor(F.col("position") / shard_records).alias("shard"), (F.col("position") % shard_records).alias("ordinal")
    )
    before = Window.partitionBy("shard").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.col("length") + len(END)).over(before), F.lit(0))
    return materialize(placed.drop("position").withColumn("offset", offset), "record-index")


def write_replica(placed: DataFrame, path: str, text: Column) -> None:
    """WARC files below ``path``, one per shard, from (shard, ordinal); records are put together where they are written."""
    files = placed.repartition(spread(placed.sparkSession), "shard").sortWithinPartitions("shard", "ordinal")
    files.select("shard", text.alias("value")).write.partitionBy("shard").option("lineSep", END).option("compression", "gzip").text(path)


def _whole(content: bytes) -> bytes:
    """What can be decompressed of a file."""
    try:
        return gzip.decompress(content)
    except (EOFError, OSError, zlib.error):
        reader, out = zlib.decompressobj(31), b""
        for at in range(0, len(content), 4096):
            try:
                out += reader.decompress(content[at : at + 4096])
            except zlib.error:
                break
        return out


def parse(data: bytes) -> Iterator[tuple[int | None, str, int, int, str]]:
    """(page id, payload mark, offset, length, digest) of the records in one file's bytes."""
    at = 0
    while data.startswith(b"WARC/1.", at):
        body = data.find(END.encode(), at)
        found = LENGTH.search(data, at, body + 2) if body >= 0 else None
        end = body + len(END) + int(found[1]) if found else -1
        if not found or end > len(data):
            return
        name = RECORD_ID.search(data, at, body)
        ident = (int(name[1]) if name[1] else None, name[2].decode()) if name else (None, "")
        yield (*ident, at, end - at, hashlib.sha256(data[at:end]).hexdigest())
        at = end + len(END)


def read_replica(spark: SparkSession, path: str) -> DataFrame:
    """The records of a replica as (page_id, payload, shard, ordinal, offset, length, digest)."""
    names = ["page_id", "payload", "shard", "ordinal", "offset", "length", "digest"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(*batch.columns):
                rows = [(i, p, shard.as_py(), n, *rest) for n, (i, p, *rest) in enumerate(parse(_whole(content.as_py())))]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 7, kinds)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").option("recursiveFileLookup", "true").load(path)
    shard = F.regexp_extract("path", r"shard=(\d+)", 1).cast("bigint")
    schema = "page_id bigint, payload string, shard bigint, ordinal bigint, offset bigint, length bigint, digest string"
    return files.select(shard.alias("shard"), "content").mapInArrow(run, schema)


def tree(own: DataFrame, height: int) -> list[DataFrame]:
    """Levels of (shard, node, hash, from, to), leaves first; every node covers an ordered offset range."""
    level = own.select("shard", F.col("ordinal").alias("node"), F.col("digest").alias("hash"), F.col("offset").alias("from"), (F.col("offset") + F.col("length")).alias("to"))
    levels = [level]
    for _ in range(height):
        told = F.array_sort(F.collect_list(F.struct("node", "hash", "from", "to")))
        text = F.concat_ws("|", F.transform(told, lambda x: F.concat_ws(":", x["hash"], x["from"].cast("string"), x["to"].cast("string"))))
        level = level.groupBy("shard", F.floor(F.col("node") / FANOUT).alias("up")).agg(F.sha2(text.cast("binary"), 256).alias("hash"), F.min("from").alias("from"), F.max("to").alias("to"))
        level = level.withColumnRenamed("up", "node")
        levels.append(level)
    return levels


def audit(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Records of ``ours`` and ``theirs`` that differ: (page_id, payload, nth, status, shard, ordinal) with the place in ours, else in theirs.

    Only branches under differing roots are followed. status: damaged, missing, added or moved.
    """
    most = max(x.agg(F.max("ordinal")).first()[0] or 0 for x in (ours, theirs))
    height = 1
    while FANOUT**height <= most:
        height += 1
    levels = list(zip(tree(ours, height), tree(theirs, height)))
    open_nodes = None
    for a, b in reversed(levels[1:]):
        b = b.select("shard", "node", *(F.col(c).alias(f"their_{c}") for c in ("hash", "from", "to")))
        if open_nodes is not None:
            above = open_nodes.select("shard", F.col("node").alias("above"))
            a, b = (x.join(above, (x["shard"] == above["shard"]) & (F.floor(x["node"] / FANOUT) == above["above"]), "left_semi") for x in (a, b))
        both = a.join(b, ["shard", "node"], "full")
        open_nodes = materialize(both.where(~F.col("hash").eqNullSafe(F.col("their_hash"))).select("shard", "node"), "differing")
    nth = Window.partitionBy("page_id", "payload").orderBy("digest", "shard", "ordinal")

    def below(own: DataFrame) -> DataFrame:
        near = own.join(open_nodes, (own["shard"] == open_nodes["shard"]) & (F.floor(own["ordinal"] / FANOUT) == open_nodes["node"]), "left_semi")
        return near.withColumn("nth", F.row_number().over(nth)).select("page_id", "payload", "nth", "shard", "ordinal", "offset", "digest")

    a, b = below(ours).alias("a"), below(theirs).alias("b")
    same = F.col("a.page_id").eqNullSafe(F.col("b.page_id")) & (F.col("a.payload") == F.col("b.payload")) & (F.col("a.nth") == F.col("b.nth"))
    status = (
        F.when(F.col("b.digest").isNull(), "missing")
        .when(F.col("a.digest").isNull(), "added")
        .when(F.col("a.digest") != F.col("b.digest"), "damaged")
        .when(~F.col("a.offset").eqNullSafe(F.col("b.offset")) | (F.col("a.shard") != F.col("b.shard")), "moved")
    )
    told = [F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in ("page_id", "payload", "nth", "shard", "ordinal")]
    return a.join(b, same, "full").select(*told, status.alias("status")).where("status IS NOT NULL")


DAMAGED, MISSING = 11, 17


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, digest and audit result of every page's record.

    The replica is written as WARC files from the same pages, with what an audit has to
    find: the last character of a record is overwritten where crc32(page_id as text)
    leaves 5 modulo DAMAGED, and records are left out where it leaves 3 modulo MISSING.
    """
    pages = table(spark, sf_dir, "pages")
    own = index(records(pages))
    mark = F.crc32(F.coalesce(F.col("page_id").cast("string"), F.lit("")).cast("binary"))
    whole = record()
    spoiled = F.when(mark % DAMAGED == 5, F.concat(F.left(whole, F.char_length(whole) - 1), F.lit("#"))).otherwise(whole)
    # pages find their places by id and payload; what travels is the page alone
    key = [F.coalesce("page_id", F.lit(-(2**63))).alias("id"), F.xxhash64("payload").alias("mark")]
    places = own.groupBy(*key).agg(F.min("shard").alias("shard"), F.min("ordinal").alias("ordinal"))
    sent = parts(pages).where(mark % MISSING != 3).withColumn("payload", payload()).select("page_id", "url", "html", *key)
    path = scratch_path(spark, "warc")
    write_replica(sent.join(places, ["id", "mark"]).drop("id", "mark"), path, spoiled)
    theirs = materialize(read_replica(spark, path), "replica-index")
    found = materialize(audit(own, theirs), "audit").where("status <> 'added'").select("shard", "ordinal", "status")
    return own.join(found, ["shard", "ordinal"], "left").select(
        "page_id", "shard", "ordinal", "offset", "length", F.col("digest").alias("record_sha256"), F.coalesce("status", F.lit("intact")).alias("status")
    )
