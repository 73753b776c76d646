"""Landed documents to the mart, micro-batch by micro-batch, rewriting only the dates a batch touches.

Below ``warehouse`` lie the silver rows of every landing (``rows_<feed>``, by month of the date and batch, sorted
by date) and the marks of both feeds (``marks``, by month of the file's day and batch): one row per landed
document, valid or not, and one per date it states. Both only grow, so a batch that is run again after a failure
finds all it needs and writes the same. Only the mart has a folder per date: listing and writing folders costs
more than reading the rows of a month, of which the sorted files skip most. A path landed again counts with its last landing, as in a batch build: hours that the later document
leaves out go, and all of them go where it does not pass validation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hazeline.functions.paths import ingest_token
from hazeline.plans.gold import gold_mart
from hazeline.plans.silver import silver_from_landing
from hazeline.session import cut_lineage
from hazeline.sources.bronze import LANDING_SCHEMA
from hazeline.sources.tables import MART
from hazeline.specs import AQI, DATE, FILE, HOUR, INGEST_TOKEN, MART_COLUMNS, WEATHER, Dataset

BATCH = "batch"
MONTH = "month"
FILE_MONTH = "file_month"
# What tells landings of one path apart, the last one being the greatest.
LANDING = ("landed_at_utc", "payload_md5")
# Dates of the mart that one task writes, each a folder of its own; by bytes alone one task would write them all.
TASK_DATES = 50
MARKS_SCHEMA = (
    f"dataset string, {FILE} string, landed_at_utc timestamp_ntz, payload_md5 string, "
    f"{DATE} date, {FILE_MONTH} date, {BATCH} bigint"
)


def stream_mart(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    checkpoint: str,
    keys: Sequence[str] = (HOUR,),
    max_bytes: int | None = None,
) -> StreamingQuery:
    """Bring the mart up to date with the documents landed since the last run, and stop.

    ``max_bytes`` bounds what one micro-batch takes in. A failed batch is run again as it was.
    """
    reader = spark.readStream.schema(LANDING_SCHEMA)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return (
        reader.parquet(landing)
        .writeStream.foreachBatch(lambda docs, number: refresh_mart(spark, docs, number, warehouse, keys))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def refresh_mart(
    spark: SparkSession, docs: DataFrame, number: int, warehouse: str, keys: Sequence[str] = (HOUR,)
) -> None:
    """Store the documents of one batch and rewrite the dates of the mart they touch.

    Touched are the dates a document of the batch states and those that earlier landings of its path stated.
    Only lists of calendar days come to the driver; they prune the folders that are read and written.
    """
    marked = docs.withColumn("payload_md5", F.md5("payload")).withColumn(FILE_MONTH, _file_month())
    _store_batch(spark, marked, number, warehouse)
    days = _touched(spark, number, warehouse)
    aqi, weather = (_current(spark, feed, days, warehouse) for feed in (AQI, WEATHER))
    # Stored, as it is read twice; it is small beside the rows of both feeds.
    mart = cut_lineage(gold_mart(aqi, weather, keys), "mart")
    # A date that lost all its hours is overwritten by one row without an hour, which readers skip.
    emptied = spark.createDataFrame([(day,) for day in days], f"{DATE} date").join(
        mart.select(DATE).distinct(), DATE, "left_anti"
    )
    dated = mart.unionByName(emptied, allowMissingColumns=True)
    _replace_partitions(dated, f"{warehouse}/{MART}", DATE, tasks=-(-len(days) // TASK_DATES))


def streamed_mart(spark: SparkSession, warehouse: str) -> DataFrame:
    """The mart kept by ``stream_mart``; filters on the date prune its folders."""
    stored = spark.read.schema(_mart_schema()).parquet(f"{warehouse}/{MART}")
    return stored.where(F.col(HOUR).isNotNull()).select(*MART_COLUMNS)


def _store_batch(spark: SparkSession, docs: DataFrame, number: int, warehouse: str) -> None:
    batch = F.lit(number).cast("bigint").alias(BATCH)
    mark = ("dataset", FILE, *LANDING)
    marks = docs.select(*mark, F.lit(None).cast("date").alias(DATE), FILE_MONTH, batch)
    for feed in (AQI, WEATHER):
        mine = docs.where(F.col("dataset") == feed.name)
        rows = silver_from_landing(mine, feed, (*LANDING, FILE_MONTH)).select("*", _month(DATE).alias(MONTH), batch)
        _replace_partitions(rows, _rows_path(feed, warehouse), MONTH, BATCH, within=(DATE,))
        stored = _rows(spark, feed, warehouse).where(F.col(BATCH) == number)
        stated = stored.withColumn("dataset", F.lit(feed.name)).select(*marks.columns).distinct()
        marks = marks.unionByName(stated)
    _replace_partitions(marks, _marks_path(warehouse), FILE_MONTH, BATCH)


def _touched(spark: SparkSession, number: int, warehouse: str) -> list:
    marks = _marks(spark, warehouse)
    new = marks.where(F.col(BATCH) == number)
    earlier = marks.where(_on_days(FILE_MONTH, _days(new, FILE_MONTH)) & (F.col(BATCH) != number))
    again = earlier.join(new.select(FILE).distinct(), FILE, "left_semi")
    dates = new.select(DATE).unionByName(again.select(DATE)).where(F.col(DATE).isNotNull())
    return sorted(_days(dates, DATE))


def _current(spark: SparkSession, feed: Dataset, days: list, warehouse: str) -> DataFrame:
    """Silver rows of the last landing of every path, on the given dates; rows without a path all stay."""
    months = sorted({day.replace(day=1) for day in days})
    rows = _rows(spark, feed, warehouse).where(F.col(MONTH).isin(months) & F.col(DATE).isin(days))
    marks = _marks(spark, warehouse).where(_on_days(FILE_MONTH, _days(rows, FILE_MONTH)))
    last = marks.where((F.col("dataset") == feed.name) & F.col(FILE).isNotNull())
    last = last.groupBy(F.col(FILE).alias("_file")).agg(F.max(F.struct(*LANDING)).alias("_last"))
    landing = F.struct(*[rows[c] for c in LANDING])
    replaced = (rows[FILE] == last["_file"]) & ~landing.eqNullSafe(last["_last"])
    return rows.join(last, replaced, "left_anti").drop(*LANDING, FILE_MONTH, MONTH, BATCH)


def _file_month() -> Column:
    """First day of the month in the name of a file, the same for every landing of its path; null if there is none."""
    return _month(F.try_to_date(F.substring(ingest_token(F.col(FILE)), 1, 8), "yyyyMMdd"))


def _month(day: str | Column) -> Column:
    return F.trunc(day, "month")


def _days(df: DataFrame, column: str) -> list:
    return [row[0] for row in df.select(column).distinct().collect()]


def _on_days(column: str, days: list) -> Column:
    known = F.col(column).isin([d for d in days if d is not None])
    return known | F.col(column).isNull() if None in days else known


def _replace_partitions(df: DataFrame, path: str, *by: str, within: Sequence[str] = (), tasks: int = 1) -> None:
    """Write ``df`` in place of the stored partitions it has rows for, files sorted by the ``within`` columns.

    Spark sizes the tasks by bytes, unless more than one is asked for.
    """
    columns = [F.col(c) for c in by]
    dealt = df.repartition(tasks, *columns) if tasks > 1 else df.hint("rebalance", *columns)
    writer = (dealt.sortWithinPartitions(*by, *within) if within else dealt).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _rows_path(feed: Dataset, warehouse: str) -> str:
    return f"{warehouse}/rows_{feed.name}"


def _marks_path(warehouse: str) -> str:
    return f"{warehouse}/marks"


def _marks(spark: SparkSession, warehouse: str) -> DataFrame:
    return spark.read.schema(MARKS_SCHEMA).parquet(_marks_path(warehouse))


def _rows(spark: SparkSession, feed: Dataset, warehouse: str) -> DataFrame:
    readings = ", ".join(f"{r.column} {r.type}" for r in feed.readings)
    schema = (
        f"{HOUR} timestamp_ntz, {DATE} date, {readings}, {INGEST_TOKEN} string, source_system string, "
        f"latitude double, longitude double, {FILE} string, landed_at_utc timestamp_ntz, "
        f"payload_md5 string, {FILE_MONTH} date, {MONTH} date, {BATCH} bigint"
    )
    return spark.read.schema(schema).parquet(_rows_path(feed, warehouse))


def _mart_schema() -> str:
    types = {r.column: r.type for feed in (AQI, WEATHER) for r in feed.readings}
    types |= {HOUR: "timestamp_ntz", "last_ingested_at_utc": "timestamp_ntz", DATE: "date"}
    types |= {"record_key": "string", "source_system": "string"}
    return ", ".join(f"{column} {types.get(column, 'double')}" for column in MART_COLUMNS)
