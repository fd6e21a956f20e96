"""Raw drops, partitioned tables and catalog documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions.scalars import before_underscore
from marketloom.operators.cleaning import flatten_structs
from marketloom.schemas import CATALOG, CATALOG_ENVELOPE
from marketloom.session import materialize
from marketloom.sources import listing


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, infer: bool = False
) -> DataFrame:
    """CSV with a header line, which names the columns whatever their order.

    With a schema all fields are read as text, its columns are taken by name (a missing
    one is an error, others are left out) and converted as ``from_text`` says; files with
    the same header are one read, however many they are, and empty files have no rows.
    Without one the types may be inferred, at the price of one more pass over the file.
    """
    paths = [path] if isinstance(path, str) else path
    for p in paths:
        if not listing.exists(spark, p):
            raise FileNotFoundError(p)
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", infer).csv(paths)
    # files of one read may order their columns differently
    by_header: dict[str, list[str]] = {}
    for p, header in zip(paths, [None] if len(paths) == 1 else listing.first_lines(spark, paths)):
        if header is not None or len(paths) == 1:
            by_header.setdefault(header or "", []).append(p)
    frames = [from_text(reader.csv(own), schema) for own in by_header.values()]
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], schema)


def from_text(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed columns of text fields, by name.

    Whole numbers may be written as ``34.0``. An empty field is null. An id that cannot be
    read is 0, so that its row is kept and counted; any other unreadable field is null.
    """
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing in the header: {', '.join(missing)}")
    out = []
    for field in schema:
        text, kind = F.trim(F.col(f"`{field.name}`")), field.dataType
        value = F.col(f"`{field.name}`") if isinstance(kind, T.StringType) else text.try_cast(kind)
        if isinstance(kind, T.IntegralType):
            value = F.coalesce(value, text.try_cast("double").try_cast(kind))
            if field.name.endswith("_id"):
                value = F.when(F.length(text) > 0, F.coalesce(value, F.lit(0).cast(kind)))
        out.append(value.alias(field.name))
    return df.select(*out)


def read_drop(spark: SparkSession, folder: str, date: str, name: str, schema: T.StructType) -> DataFrame:
    """The dated drop ``<date>_<name>.csv`` of a landing folder."""
    return read_csv(spark, f"{folder}/{date}_{name}.csv", schema)


def read_partition(
    spark: SparkSession, root: str, date: str | None = None, key: str = "ingestion_date", schema: T.StructType | None = None
) -> DataFrame:
    """One date partition of a table (the newest by default), without its partition column.

    Parquet files are preferred, also those of single batches in folders of their own below
    the date, as streams land them; a partition that holds only CSV files is read as
    CSV. The choice is made from the file listing because Spark reads are lazy.
    """
    date = date or listing.latest_partition(spark, root, key)
    folder = f"{root}/{key}={date}"
    if listing.has_files(spark, folder, ".parquet"):
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.option("recursiveFileLookup", True).parquet(folder)
    names = [n for n in listing.list_names(spark, folder) if not n.startswith(("_", "."))]
    csv = [f"{folder}/{n}" for n in names if n.endswith(".csv")]
    if csv:
        return read_csv(spark, csv, schema, infer=schema is None)
    raise FileNotFoundError(f"no data files in {folder}")


def read_dates(spark: SparkSession, root: str, key: str = "ingestion_date", date: str | None = None) -> DataFrame:
    """The partitioned table; with ``date`` a static filter that prunes the other partitions."""
    values = spark.read.parquet(root)
    typed = values.withColumn(key, F.col(key).cast("string"))
    return typed if date is None else typed.where(F.col(key) == date)


def read_all_distinct(spark: SparkSession, root: str, key: str = "ingestion_date") -> DataFrame:
    """Distinct rows over all partitions; the date itself does not tell rows apart."""
    return spark.read.parquet(root).drop(key).dropDuplicates()


def read_catalog_json(
    spark: SparkSession, path: str, product: T.StructType = CATALOG, lines: bool = False
) -> DataFrame:
    """Products from documents that are either ``{count, products: [...]}`` or a bare list.

    A document may be of any size: its bytes are split among tasks (see ``_product_texts``).
    ``lines=True`` reads one document (or one product) per line, as ``write_catalog_json``
    lands them. Unreadable documents are left out. Nested objects are flattened to dotted names.
    """
    if not lines:
        found = _product_texts(spark, path).select(F.from_json("text", product).alias("p")).where("p IS NOT NULL")
        return flatten_structs(found.select("p.*"))
    corrupt = "_corrupt"
    envelope = T.StructType(
        [
            *CATALOG_ENVELOPE.fields[:1],
            T.StructField("products", T.ArrayType(product)),
            *product.fields,
            T.StructField(corrupt, T.StringType()),
        ]
    )
    records = (
        spark.read.schema(envelope)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt)
        .json(path)
        .where(F.col(corrupt).isNull())
    )
    bare = F.array(F.struct(*[F.col(f"`{f.name}`") for f in product]))
    items = records.select(F.explode(F.coalesce(F.col("products"), bare)).alias("p"))
    return flatten_structs(items.select("p.*"))


def _product_texts(spark: SparkSession, path: str) -> DataFrame:
    """(file, number, text) of the objects in the product array of each JSON document.

    Documents are read as pieces that end at a closing brace, which Spark splits by bytes.
    Where a product ends follows from the nesting depth, and that from all pieces before:
    every piece tells how many quotes it has and how it changes the depth, once for a start
    inside a string and once outside. Both add up along a split, and the sums of the splits,
    one row each, along the document. So no task reads more than its split.
    """
    read = spark.read.option("lineSep", "}").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    plain = F.regexp_replace("value", r"\\.", "")

    def depth(text: Column) -> Column:
        """Change of depth outside strings; the brace at the end counts unless a string is open there."""
        outside = F.regexp_replace(text, r'"[^"]*("|$)', "")
        closes = F.when(F.regexp_count(text, F.lit('"')) % 2 == 0, 1).otherwise(0)
        return F.regexp_count(outside, F.lit(r"[{\[]")) - F.regexp_count(outside, F.lit(r"[}\]]")) - closes

    facts = {"quotes": F.regexp_count(plain, F.lit('"')), "d0": depth(plain), "d1": depth(F.concat(F.lit('"'), plain))}
    pieces = materialize(read.withColumns(facts).withColumn("mid", F.monotonically_increasing_id()), "pieces")
    # along a split, for both states that it may start in
    along = Window.partitionBy("file", "start").orderBy("mid")
    open_at = F.coalesce(F.sum("quotes").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    pieces = pieces.withColumn("odd", open_at)
    for s in (0, 1):
        pieces = pieces.withColumn(f"c{s}", F.sum(F.when(F.col("odd") == s, F.col("d0")).otherwise(F.col("d1"))).over(along))
    # one row per split of a document
    splits = pieces.groupBy("file", "start").agg(F.sum("quotes").alias("quotes"), F.max_by("c0", "mid").alias("c0"), F.max_by("c1", "mid").alias("c1"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("odd_at", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    own = F.when(F.col("odd_at") == 0, F.col("c0")).otherwise(F.col("c1"))
    splits = splits.withColumn("depth_at", F.coalesce(F.sum(own).over(before), F.lit(0))).select("file", "start", "odd_at", "depth_at")
    level = F.col("depth_at") + F.when(F.col("odd_at") == 0, F.col("c0")).otherwise(F.col("c1"))
    placed = pieces.join(splits, ["file", "start"]).select("file", "start", "mid", "value", level.alias("depth"), (F.col("odd") + F.col("odd_at") + F.col("quotes")).alias("odd_after"))
    documents = placed.groupBy("file").agg(
        F.min_by(F.ltrim("value").substr(1, 1), F.struct("start", "mid")).alias("first"), F.max_by(F.struct("depth", "value", "odd_after"), F.struct("start", "mid")).alias("last")
    )
    ended = (F.col("last.depth") == 0) | ((F.col("last.depth") == -1) & F.col("last.value").rlike(r"^[\s\]]*$"))
    documents = documents.where(ended & (F.col("last.odd_after") % 2 == 0)).select("file", F.when(F.col("first") == "[", 1).otherwise(2).alias("base"))
    known = materialize(placed.join(documents, "file"), "placed")
    done = (F.col("depth") == F.col("base")) & (F.col("odd_after") % 2 == 0)
    ends = known.withColumn("ends", F.sum(done.cast("int")).over(along) - done.cast("int"))
    counts = known.groupBy("file", "start").agg(F.sum(done.cast("int")).alias("n"))
    counts = counts.select("file", "start", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    numbered = ends.join(counts, ["file", "start"]).withColumn("number", F.col("before") + F.col("ends"))
    # the pieces of one product
    text = F.concat_ws("}", F.transform(F.array_sort(F.collect_list(F.struct("start", "mid", "value"))), lambda x: x["value"]), F.lit(""))
    texts = numbered.groupBy("file", "number").agg(text.alias("text"), F.max(done.cast("int")).alias("whole"))
    body = F.when(F.col("number") == 0, F.regexp_replace("text", r'(?s)^\s*(\[|\{.*?"products"\s*:\s*\[)', "")).otherwise(F.col("text"))
    texts = texts.withColumn("text", F.regexp_replace(body, r"^[\s,]+", ""))
    over = texts.where("text LIKE ']%'").groupBy("file").agg(F.min("number").alias("stop"))
    return texts.join(over, "file", "left").where("whole = 1 AND (stop IS NULL OR number < stop)").select("file", "number", "text")


def latest_source_date(files: DataFrame, name: str | Column = "_metadata.file_name") -> DataFrame:
    """Largest date prefix among file names, as one row; by default of the files behind a scan."""
    prefix = before_underscore(F.col(name) if isinstance(name, str) else name)
    dates = files.select(prefix.alias("d")).where(F.col("d").rlike("^[0-9]{8}$"))
    return dates.agg(F.max("d").alias("latest_date"))


def latest_source_file(spark: SparkSession, folder: str, suffix: str) -> str | None:
    """Name of the newest ``<date><suffix>`` file, from the listing alone."""
    names = [n for n in listing.list_names(spark, folder) if n.endswith(suffix)]
    return max(names, key=lambda n: n.split("_")[0], default=None)


# --- writers --------------------------------------------------------------


def write_partitions(df: DataFrame, root: str, key: str = "ingestion_date") -> None:
    """Replace exactly those partitions that ``df`` has rows for.

    The rebalance hint sizes the output files and splits a date with most of the
    rows over several tasks.
    """
    (
        df.hint("rebalance", key)
        .write.partitionBy(key)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(root)
    )


def write_date(df: DataFrame, root: str, date: str, key: str = "ingestion_date") -> None:
    """Replace one date partition; no shuffle, each task writes its own rows."""
    df.write.mode("overwrite").parquet(f"{root}/{key}={date}")


def write_catalog_json(products: DataFrame, root: str, date: str) -> None:
    """Land products as one JSON record per line in the same partition layout."""
    products.write.mode("overwrite").json(f"{root}/ingestion_date={date}")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
