"""Incremental bronze to silver: each run picks up the documents landed since the last one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hazeline.plans.silver import silver_from_landing
from hazeline.sources.bronze import LANDING_SCHEMA
from hazeline.specs import FILE, Dataset


def landing_stream(
    spark: SparkSession, root: str, dataset: Dataset, max_bytes: int | None = None
) -> DataFrame:
    """New documents of one feed. ``max_bytes`` bounds what one micro-batch takes in."""
    reader = spark.readStream.schema(LANDING_SCHEMA)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(root).where(F.col("dataset") == dataset.name)


def current_rows(staged: DataFrame) -> DataFrame:
    """Silver rows of the last landing of each file: a path landed again replaces what was there.

    The stream appends the rows of every landing; this is what a batch run over the newest documents
    holds. Counts per file are joined as Spark sees fit; rows without a file are all kept.
    """
    last = staged.where(F.col(FILE).isNotNull()).groupBy(F.col(FILE).alias("_file"))
    last = last.agg(F.max("landed_at_utc").alias("_last"))
    older = (staged[FILE] == last["_file"]) & ~staged["landed_at_utc"].eqNullSafe(last["_last"])
    return staged.join(last, older, "left_anti")


def stream_silver(
    spark: SparkSession,
    root: str,
    target: str,
    checkpoint: str,
    dataset: Dataset,
    max_bytes: int | None = None,
) -> StreamingQuery:
    """Append silver rows of new, valid documents to ``target`` and stop when caught up.

    Rows only: validation, parsing and exploding keep no state, so there is nothing to bound or
    expire. Documents that fail stay in bronze, where the quarantine frame lists them. The mart is
    recomputed in batch, as choosing the newest version needs every version.
    """
    rows = silver_from_landing(
        landing_stream(spark, root, dataset, max_bytes),
        dataset,
        carry=("ingest_date", "landed_at_utc"),
    )
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("ingest_date")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
