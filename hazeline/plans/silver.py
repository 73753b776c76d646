"""Bronze documents to silver rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.functions.paths import ingest_token
from hazeline.operators.explode import explode_hourly, standardize
from hazeline.operators.validation import parse_valid_documents
from hazeline.specs import AQI, FILE, INGEST_TOKEN, WEATHER, Dataset


def silver(docs: DataFrame, dataset: Dataset, carry: Sequence[str] = ()) -> DataFrame:
    """Typed rows of parsed documents: one per document and hour.

    The file name is taken apart once per document, before it is opened into hours.
    """
    docs = docs.withColumn(INGEST_TOKEN, ingest_token(F.col(FILE)))
    return standardize(explode_hourly(docs, dataset, (INGEST_TOKEN, *carry)), dataset, carry)


def silver_aqi(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return silver(docs, AQI, carry)


def silver_weather(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return silver(docs, WEATHER, carry)


def silver_from_landing(landed: DataFrame, dataset: Dataset, carry: Sequence[str] = ()) -> DataFrame:
    """Silver rows of the landed documents that pass validation. No shuffle anywhere."""
    good = parse_valid_documents(landed.select(FILE, "payload", *carry), dataset)
    return silver(good, dataset, carry)
