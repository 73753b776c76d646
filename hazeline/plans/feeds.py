"""Feeds derived from an ``events`` table, so that every operator can run on given data.

Clicks, views and errors become the AQI feed, purchases and signups the weather feed. An event stands
either for one silver row (``*_feed``) or for one raw document that states the hour of the event
and the three after it (``documents``). Both are row by row: no shuffle, and the size of a document
does not depend on the data.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.functions.clock import document_time, hour_floor, ingest_text
from hazeline.functions.numbers import whole
from hazeline.functions.paths import object_path, path_of
from hazeline.specs import AQI, DATE, FILE, HOUR, INGEST_TOKEN, WEATHER, Dataset

FILE_PREFIX = "feed_raw"
LATITUDE, LONGITUDE = 13.75, 100.5
EVENT_TYPES = {AQI.name: ("click", "view", "error"), WEATHER.name: ("purchase", "signup")}
# Hours one document covers.
HOURS = 4
# What becomes of the event value in each document field.
SCALES = {
    "pm2_5": lambda v: v,
    "pm10": lambda v: v * 1.5,
    "us_aqi": lambda v: v,
    "temperature_2m": lambda v: v / 10,
    "relative_humidity_2m": lambda v: v / 2,
    "wind_speed_10m": lambda v: v / 20,
}
KEPT = ("event_id", "user_id")


def events_of(events: DataFrame, dataset: Dataset) -> DataFrame:
    return events.where(F.col("event_type").isin(*EVENT_TYPES[dataset.name]))


def feed(events: DataFrame, dataset: Dataset) -> DataFrame:
    """Silver rows of one feed: one per event, with the event and user it came from."""
    value, day = F.col("value"), F.col("ts").cast("date")
    readings = [
        (whole if r.type == "int" else lambda c: c)(SCALES[r.field](value)).alias(r.column)
        for r in dataset.readings
    ]
    rows = events_of(events, dataset).withColumn(INGEST_TOKEN, ingest_text(F.col("ts")))
    return rows.select(
        hour_floor(F.col("ts")).alias(HOUR),
        day.alias(DATE),
        *readings,
        INGEST_TOKEN,
        F.lit(dataset.source_system).alias("source_system"),
        F.lit(LATITUDE).alias("latitude"),
        F.lit(LONGITUDE).alias("longitude"),
        path_of(day, F.col(INGEST_TOKEN), dataset.name, FILE_PREFIX).alias(FILE),
        *KEPT,
    )


def documents(events: DataFrame, dataset: Dataset, defects: bool = False) -> DataFrame:
    """Raw documents of one feed, in landing-table columns plus event and user.

    With ``defects`` the last digit of the user decides what is wrong with the document: 0 no
    hourly section, 1 no last field, 2 a short second field, 3 an unreadable first time, 4 only
    null readings, 5 empty arrays, 6 to 9 nothing.
    """
    digit = F.col("user_id") % 10 if defects else F.lit(9)
    times = F.array(
        *[document_time(F.col("_start") + F.lit(timedelta(hours=i))) for i in range(HOURS)]
    )
    times = F.when(
        digit == 3, F.concat(F.array(F.lit("not-a-timestamp")), F.slice(times, 2, HOURS))
    ).otherwise(times)
    empty = F.array().cast("array<string>")
    fields = [F.when(digit == 5, empty).otherwise(times).alias("time")]
    for place, name in enumerate(dataset.reading_fields):
        fields.append(_readings(name, place, digit, dataset).alias(name))
    hourly = F.when(digit != 0, F.struct(*fields))
    payload = F.to_json(
        F.struct(
            F.lit(LATITUDE).alias("latitude"),
            F.lit(LONGITUDE).alias("longitude"),
            hourly.alias("hourly"),
        )
    )
    started = events_of(events, dataset).withColumn("_start", hour_floor(F.col("ts")))
    return started.select(
        object_path(F.col("ts"), dataset.name, FILE_PREFIX).alias(FILE),
        payload.alias("payload"),
        F.col("ts").alias("landed_at_utc"),
        F.lit(dataset.name).alias("dataset"),
        F.col("ts").cast("date").alias("ingest_date"),
        *KEPT,
    )


def _readings(name: str, place: int, digit: Column, dataset: Dataset) -> Column:
    values = F.array(*[SCALES[name](F.col("value") + float(i)) for i in range(HOURS)])
    nulls = F.array_repeat(F.lit(None).cast("double"), HOURS)
    empty = F.array().cast("array<double>")
    choice = F.when(digit == 4, nulls).when(digit == 5, empty)
    if place == 1:
        choice = choice.when(digit == 2, F.slice(values, 1, HOURS - 1))
    if place == len(dataset.readings) - 1:
        choice = choice.when(digit == 1, F.lit(None))
    return choice.otherwise(values)


def ragged_documents(events: DataFrame) -> DataFrame:
    """Parsed AQI documents whose second array is one short and whose third is absent for half."""
    times = F.array(F.lit("2024-01-01T00:00"), F.lit("2024-01-01T01:00"), F.lit("2024-01-01T02:00"))
    value = F.col("value")
    fields = {
        "time": times,
        "pm2_5": F.array(value, value + 1.0),
        "pm10": F.when(F.col("user_id") % 2 == 0, F.array(value, value, value)),
        "us_aqi": F.array(value, value * 2.0, value * 3.0),
    }
    return events_of(events, AQI).select(
        F.lit(LATITUDE).alias("latitude"),
        F.lit(LONGITUDE).alias("longitude"),
        F.struct(*[c.alias(n) for n, c in fields.items()]).alias("hourly"),
        object_path(F.col("ts"), AQI.name, FILE_PREFIX).alias(FILE),
        *KEPT,
    )
