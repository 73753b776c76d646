"""Documents with parallel hourly arrays into one typed row per hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.functions.numbers import whole
from hazeline.functions.paths import ingest_token
from hazeline.specs import DATE, FILE, HOUR, INGEST_TOKEN, Dataset


def explode_hourly(docs: DataFrame, dataset: Dataset, carry: Sequence[str] = ()) -> DataFrame:
    """One row per hour of each document, with domain names and types.

    ``docs`` holds ``latitude, longitude, hourly, raw_file_name`` and any ``carry`` columns.
    Arrays shorter than the longest one, and absent arrays, are padded with nulls; a document
    without any array elements gives no rows. No shuffle: each document is opened where it lies.
    """
    kept = ["latitude", "longitude", FILE, *carry]
    schema = dataset.document_schema["hourly"].dataType
    arrays = [
        # arrays_zip is null as soon as one input is null, so absent arrays become empty ones
        F.coalesce(F.col("hourly")[f.name], F.array().cast(f.dataType)).alias(f.name)
        for f in schema
    ]
    rows = docs.select(*kept, *arrays).select(
        *kept, F.inline(F.arrays_zip(*dataset.required_fields))
    )
    readings = [
        (whole(F.col(r.field)) if r.type == "int" else F.col(r.field).cast(r.type)).alias(r.column)
        for r in dataset.readings
    ]
    return rows.select(
        F.col("time").cast("timestamp_ntz").alias(HOUR),
        *readings,
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        FILE,
        *carry,
    )


def standardize(rows: DataFrame, dataset: Dataset, carry: Sequence[str] = ()) -> DataFrame:
    """Exploded rows with their date, ingest time and source system, in silver column order.

    The ingest time is read off the file name unless the rows already bring it along.
    """
    known = INGEST_TOKEN in rows.columns
    token = F.col(INGEST_TOKEN) if known else ingest_token(F.col(FILE)).alias(INGEST_TOKEN)
    return rows.select(
        HOUR,
        F.col(HOUR).cast("date").alias(DATE),
        *dataset.metric_columns,
        token,
        F.lit(dataset.source_system).alias("source_system"),
        "latitude",
        "longitude",
        FILE,
        *carry,
    )
