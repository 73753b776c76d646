"""Raw documents: landing them verbatim, reading them back, listing them.

Two layouts are read. A *document tree* holds JSON files, usually one per document, under
``<dataset>/ingest_date=<day>/``. The *landing table* keeps the same documents verbatim as rows of
Parquet, partitioned by dataset and ingest date, with the object path as a column; it is what
this library writes, since billions of small files cannot be listed, let alone scanned, quickly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.functions.paths import ingest_token
from hazeline.operators.versions import latest_version
from hazeline.specs import FILE, Dataset

LANDING_PARTITIONS = ("dataset", "ingest_date")
LANDING_SCHEMA = T.StructType(
    [
        T.StructField(FILE, T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("landed_at_utc", T.TimestampNTZType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("ingest_date", T.DateType()),
    ]
)


def land_documents(docs: DataFrame, root: str) -> None:
    """Append documents (columns of ``LANDING_SCHEMA``) to the landing table, payload untouched.

    The rebalance hint lets Spark size the files: small partitions share tasks, and a day or feed
    with a large share of all documents is split over many.
    """
    (
        docs.select(*LANDING_SCHEMA.names)
        .hint("rebalance", *[F.col(c) for c in LANDING_PARTITIONS])
        .write.mode("append")
        .partitionBy(*LANDING_PARTITIONS)
        .parquet(root)
    )


def read_landing(spark: SparkSession, root: str, dataset: Dataset | None = None) -> DataFrame:
    """The landing table, or only the partitions of one feed."""
    landed = spark.read.schema(LANDING_SCHEMA).parquet(root)
    return landed if dataset is None else landed.where(F.col("dataset") == dataset.name)


def latest_landing(landed: DataFrame, order: Sequence[Column] = ()) -> DataFrame:
    """One document per object path: a path landed again replaces what was there.

    The last landing of every repeated path is found on rows without payloads and hashed; documents stream past it,
    so no task sorts payloads or holds more of them than the last ones of its repeated paths. Exact copies of a last
    landing become one. Documents without a path are all kept.
    """
    newest = list(order) or [F.col("landed_at_utc").desc_nulls_last(), F.md5("payload").desc_nulls_last()]
    counts = landed.groupBy(FILE).agg(F.count(F.lit(1)).alias("_n"))
    repeated = counts.where((F.col("_n") > 1) & F.col(FILE).isNotNull()).select(FILE)
    content = F.struct(*[c for c in landed.columns if c not in (FILE, "payload")], F.sha2("payload", 256))
    again = landed.join(repeated.hint("shuffle_hash"), FILE, "left_semi")
    last = latest_version(again, [FILE], newest).select(F.col(FILE).alias("_file"), content.alias("_last"))
    seen = landed.join(last.hint("shuffle_hash"), F.col(FILE) == F.col("_file"), "left")
    once = seen.where(F.col("_file").isNull())
    kept = seen.where(F.col("_file").isNotNull() & content.eqNullSafe(F.col("_last")))
    return once.select(*landed.columns).unionByName(kept.select(*landed.columns).distinct())


def land_tree(
    spark: SparkSession, tree: str, root: str, dataset: Dataset, pattern: str = "*.json"
) -> None:
    """Land the files of an existing document tree, at any depth, with their text untouched.

    The path of a file is its lineage, its name carries the ingest time, and its time of change stands
    for the time it landed. Listing the files takes driver memory; a tree of billions of files is best
    landed one date folder at a time.
    """
    files = (
        spark.read.format("text")
        .option("wholetext", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(tree)
    )
    token = ingest_token(F.col("_metadata.file_path"))
    land_documents(
        files.select(
            F.col("_metadata.file_path").alias(FILE),
            F.col("value").alias("payload"),
            F.to_timestamp_ntz(
                F.date_format(F.col("_metadata.file_modification_time"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
            ).alias("landed_at_utc"),
            F.lit(dataset.name).alias("dataset"),
            F.to_date(F.substring(token, 1, 8), "yyyyMMdd").alias("ingest_date"),
        ),
        root,
    )


def parse_documents(landed: DataFrame, dataset: Dataset) -> DataFrame:
    """``payload`` text into ``latitude, longitude, hourly``; a text that does not fit is an error.

    Give it documents that passed validation.
    """
    schema = T.StructType([*dataset.document_schema, T.StructField("_bad", T.StringType())])
    document = F.from_json(F.col("payload"), schema, {"columnNameOfCorruptRecord": "_bad"})
    doc = F.col("_doc")
    misfit = F.raise_error(F.concat(F.lit("document does not fit its schema: "), F.col(FILE)))
    hourly = F.when(doc.isNull() | doc["_bad"].isNotNull(), misfit).otherwise(doc["hourly"])
    kept = [c for c in landed.columns if c != "payload"]
    place = [doc[c].alias(c) for c in ("latitude", "longitude")]
    return landed.withColumn("_doc", document).select(*kept, *place, hourly.alias("hourly"))


def read_document_tree(
    spark: SparkSession,
    root: str,
    dataset: Dataset,
    one_per_file: bool = True,
    pattern: str = "*.json",
    any_depth: bool = False,
) -> DataFrame:
    """Parsed documents of a JSON tree with their file as lineage; a broken file is an error.

    ``root`` may hold globs. ``ingest_date=`` folders become a column that prunes folders. Trees
    compacted to one document per line are read with ``one_per_file=False``; large files are then
    split between tasks. ``any_depth`` takes files from folders of any name and depth, and then
    there is no folder column.
    """
    reader = spark.read.schema(dataset.document_schema).option("multiLine", one_per_file)
    reader = reader.option("mode", "FAILFAST").option("recursiveFileLookup", any_depth)
    docs = reader.option("pathGlobFilter", pattern).json(root)
    return docs.withColumn(FILE, F.col("_metadata.file_path"))


def read_document_texts(spark: SparkSession, root: str) -> DataFrame:
    """Whole files of a JSON tree as ``payload`` text, for validation and landing."""
    texts = spark.read.option("pathGlobFilter", "*.json").text(root, wholetext=True)
    return texts.withColumnRenamed("value", "payload").withColumn(FILE, F.col("_metadata.file_path"))


def read_document_bytes(spark: SparkSession, root: str) -> DataFrame:
    """Whole files of a JSON tree as bytes."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(root)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """``path, length, modificationTime`` of every file below ``root``, sorted; contents unread.

    A root that does not exist gives no rows.
    """
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, length bigint, modificationTime timestamp")
    return files.select("path", "length", "modificationTime").orderBy("path")


def list_objects(landed: DataFrame, prefix: str = "") -> DataFrame:
    """Sorted object paths in the landing table that start with ``prefix``; payloads unread."""
    return (
        landed.where(F.startswith(F.col(FILE), F.lit(prefix)))
        .select(FILE)
        .distinct()
        .orderBy(FILE)
    )
