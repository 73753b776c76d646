"""Silver rows to the mart: newest AQI version per hour with the newest weather beside it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.functions.clock import ingest_instant
from hazeline.functions.paths import record_key
from hazeline.operators.versions import latest_version, newest_first
from hazeline.specs import AQI, HOUR, INGEST_TOKEN, MART_COLUMNS, WEATHER, Dataset


def latest_staged(
    staged: DataFrame, dataset: Dataset, keys: Sequence[str], tie_break: Sequence[str] | None
) -> DataFrame:
    """Newest version per key. The default tie-break is the readings themselves, so a document
    that states an hour twice gives the same winner on every run."""
    ties = dataset.metric_columns if tie_break is None else tie_break
    if "landed_at_utc" in staged.columns:  # of one file landed twice, the later landing
        ties = ["landed_at_utc", *ties]
    return latest_version(staged, keys, newest_first(ties))


def gold_mart(
    staged_aqi: DataFrame,
    staged_weather: DataFrame,
    keys: Sequence[str] = (HOUR,),
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key of the AQI feed; hours without weather keep nulls.

    Both sides are cut to one row per key before they meet, and the ranking already partitions
    them by the join keys, so the join adds no shuffle of its own. Keys beyond the hour, such as
    latitude and longitude, become part of the record key and are kept as columns.
    """
    extra = [k for k in keys if k != HOUR]
    aqi = latest_staged(staged_aqi, AQI, keys, tie_break)
    weather = latest_staged(staged_weather, WEATHER, keys, tie_break)
    both = aqi.join(weather.select(*keys, *WEATHER.metric_columns), list(keys), "left")
    return (
        both.withColumn("record_key", record_key(*[F.col(c) for c in (HOUR, INGEST_TOKEN, *extra)]))
        .withColumn("last_ingested_at_utc", ingest_instant(F.col(INGEST_TOKEN)))
        .select(*MART_COLUMNS, *[k for k in extra if k not in MART_COLUMNS])
    )
