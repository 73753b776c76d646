"""Model tables: full-refresh writes, existence, and the mart as the serving layer reads it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from hazeline.functions.clock import as_utc
from hazeline.specs import DATE, HOUR, HOURLY_COLUMNS, WEATHER

MART = "fct_aqi_hourly"


def write_model(df: DataFrame, path: str, partition_by: Sequence[str] = (DATE,)) -> DataFrame:
    """Replace the model stored at ``path`` and return it as stored.

    Rebalancing by the partition columns keeps one date in few files of even size, and splits a
    date that is far larger than the others instead of giving it to one task.
    """
    _full_refresh(df, partition_by).parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    return stored.select(*df.columns)


def write_table(
    df: DataFrame, name: str, partition_by: Sequence[str] = (DATE,), path: str | None = None
) -> None:
    """Replace the catalog table ``name``, stored at ``path`` or else in the warehouse."""
    writer = _full_refresh(df, partition_by).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def _full_refresh(df: DataFrame, partition_by: Sequence[str]) -> DataFrameWriter:
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    # static even if the session prefers to replace only the partitions that get new rows
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    return writer.partitionBy(*partition_by)


def has_mart(spark: SparkSession, name: str = MART) -> bool:
    """Does the catalog hold the mart?"""
    return spark.catalog.tableExists(name)


def has_model(spark: SparkSession, path: str) -> bool:
    """Is a model stored at ``path``?"""
    try:
        spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False
    return True


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """A stored model whose files may differ in columns, as older and newer writers left them.

    One read with the columns of all files, nulls where a file lacks one. Spark merges the schemas in a job over the
    footers; filters on partition columns still prune folders.
    """
    return spark.read.option("mergeSchema", True).parquet(path)


def load_hourly(mart: DataFrame) -> DataFrame:
    """The mart as served, in order of the hour."""
    place = [F.col(c).asc_nulls_last() for c in ("latitude", "longitude")]
    return served_columns(mart).orderBy(F.col(HOUR).asc_nulls_last(), *place)


def served_columns(mart: DataFrame) -> DataFrame:
    """Fixed columns in fixed order, with the ingest time as a zoned instant; rows in any order.

    Weather columns an older mart lacks are filled with typed nulls.
    """
    types = dict(mart.dtypes)
    columns = []
    for name in HOURLY_COLUMNS:
        if name in WEATHER.metric_columns and name not in types:
            columns.append(F.lit(None).cast("double").alias(name))
        elif name == "last_ingested_at_utc":
            columns.append(as_utc(F.col(name), types[name]).alias(name))
        else:
            columns.append(F.col(name))
    return mart.select(*columns)
