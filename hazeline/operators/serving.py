"""What the mart is asked for: rollups, series, peaks, current conditions, freshness.

Where it makes sense functions take ``keys`` (say, a location column). Without keys they answer
for the whole frame, as for a single location.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.functions.bands import aqi_band
from hazeline.functions.clock import as_naive_utc, is_stale, minute_text, naive_literal
from hazeline.functions.numbers import exact_mean, fixed, half_even, signed_whole
from hazeline.operators.versions import first_rows
from hazeline.specs import DATE, HOUR, METRIC_LABELS, WEATHER

DAILY_MEANS = (
    ("avg_aqi", "us_aqi"),
    ("avg_pm25", "pm25"),
    ("avg_pm10", "pm10"),
    ("avg_temperature_c", "temperature_c"),
    ("avg_relative_humidity", "relative_humidity"),
    ("avg_wind_speed_kph", "wind_speed_kph"),
)
MAX_AGE = timedelta(hours=2)
NOT_AVAILABLE = "N/A"


def date_window(hourly: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Rows of an inclusive range of dates; an open end is not filtered.

    The test is on the partition column of a stored mart, so other dates are not read.
    """
    if start is not None:
        hourly = hourly.where(F.col(DATE) >= F.lit(start))
    if end is not None:
        hourly = hourly.where(F.col(DATE) <= F.lit(end))
    return hourly


def single_date(hourly: DataFrame, day: date) -> DataFrame:
    return date_window(hourly, day, day)


def daily_summary(hourly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Means (one decimal) and peak index per date. Rows without a date are left out.

    Without keys the result is in date order; with keys it may be large and is not sorted.
    """
    means = {name: half_even(exact_mean(F.col(c)), 1).alias(name) for name, c in DAILY_MEANS}
    columns = [means.pop("avg_aqi"), F.max("us_aqi").alias("max_aqi"), *means.values()]
    daily = hourly.where(F.col(DATE).isNotNull()).groupBy(*keys, DATE).agg(*columns)
    return daily if keys else daily.orderBy(DATE)


def metric_options(hourly: DataFrame) -> DataFrame:
    """``metric_key, label`` of the series that can be shown.

    The index always can, particulates if their column is there, weather only if it has a value.
    """
    offered = [m for m in METRIC_LABELS if m == "us_aqi" or m in hourly.columns]
    seen = hourly.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(m).alias(m) for m in offered if m in WEATHER.metric_columns],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric_key"),
                F.lit(METRIC_LABELS[m]).alias("label"),
                (F.col(m) > 0 if m in WEATHER.metric_columns else F.lit(True)).alias("_shown"),
            )
            for m in offered
        ]
    )
    return seen.select(F.inline(rows)).where("_shown").drop("_shown")


def metric_option_map(hourly: DataFrame) -> dict[str, str]:
    """``metric_options`` as a dict in display order; at most six entries."""
    found = {r["metric_key"]: r["label"] for r in metric_options(hourly).collect()}
    return {m: found[m] for m in METRIC_LABELS if m in found}


def melt_metrics(hourly: DataFrame, options: Mapping[str, str] | None = None) -> DataFrame:
    """Long form ``forecast_timestamp_local, value, metric``; nulls are kept.

    With no series chosen only the index is shown.
    """
    options = options or {"us_aqi": METRIC_LABELS["us_aqi"]}
    label = F.lit(None).cast("string")
    for key, text in options.items():
        label = F.when(F.col("metric_key") == key, F.lit(text)).otherwise(label)
    doubles = [F.col(m).cast("double").alias(m) for m in options]
    return (
        hourly.select(HOUR, *doubles)
        .unpivot([HOUR], list(options), "metric_key", "value")
        .withColumn("metric", label)
        .drop("metric_key")
    )


def with_band(hourly: DataFrame) -> DataFrame:
    """``hourly`` with ``band_label, band_color, band_advisory``."""
    return (
        hourly.withColumn("_band", aqi_band(F.col("us_aqi")))
        .withColumns({f"band_{f}": F.col("_band")[f] for f in ("label", "color", "advisory")})
        .drop("_band")
    )


def band_counts(hourly: DataFrame) -> DataFrame:
    """Number of hours in each band."""
    label = aqi_band(F.col("us_aqi"))["label"].alias("band_label")
    return hourly.groupBy(label).agg(F.count(F.lit(1)).alias("hours"))


def freshness(
    df: DataFrame,
    keys: Sequence[str] = (),
    ingested: str = "last_ingested_at_utc",
    now: datetime | None = None,
    max_age: timedelta = MAX_AGE,
) -> DataFrame:
    """Latest ingestion per key and whether it is older than ``max_age``."""
    moment = naive_literal(now or datetime.now(timezone.utc))
    latest = df.groupBy(*keys).agg(F.max(ingested).alias("last_ingested_at_utc"))
    naive = as_naive_utc(F.col("last_ingested_at_utc"), dict(df.dtypes)[ingested])
    return latest.withColumn("is_stale", is_stale(naive, moment, max_age))


def peak_hour(hourly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The row with the highest index, the earliest of several. Rows without an index are left out."""
    order = [F.col("us_aqi").desc(), *_by_hour(hourly)]
    return first_rows(hourly.where(F.col("us_aqi").isNotNull()), keys, order, 1)


def current_hour(hourly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The row of the earliest hour; of several, the one with the smallest place and record key."""
    return first_rows(hourly, keys, _by_hour(hourly), 1)


def _ties(hourly: DataFrame) -> list[str]:
    """Columns that tell rows of one hour apart, so that no answer depends on the order of rows."""
    return [c for c in ("latitude", "longitude", "record_key") if c in hourly.columns]


def _by_hour(hourly: DataFrame) -> list[Column]:
    return [F.col(HOUR).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in _ties(hourly)]]


def current_delta(hourly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Index of the earliest hour and how it differs from the hour after (0 if there is none)."""
    ties = [c for c in _ties(hourly) if c not in keys]
    narrow = hourly.select(*keys, HOUR, "us_aqi", *ties)
    two = first_rows(narrow, keys, _by_hour(narrow), 2)
    place = F.when(F.col(HOUR).isNotNull(), F.struct(HOUR, *ties))
    return (
        two.groupBy(*keys)
        .agg(
            F.min(HOUR).alias(HOUR),
            F.min_by("us_aqi", place).alias("us_aqi"),
            F.max_by("us_aqi", place).alias("_next"),
            F.count(F.lit(1)).alias("_rows"),
        )
        .where(F.col("_rows") > 0)
        .select(*keys, HOUR, "us_aqi", (F.col("us_aqi") - F.col("_next")).alias("aqi_delta"))
    )


def map_points(hourly: DataFrame, keys: Sequence[str] = ("latitude", "longitude")) -> DataFrame:
    """Coordinates and index of the earliest hour, per location (or one row without keys)."""
    return current_hour(hourly, keys).select(
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        "us_aqi",
    )


def window_kpis(hourly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Range of dates, mean particulates, peak index and latest ingestion; no row for no data."""
    return (
        hourly.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("hours"),
            F.min(DATE).alias("min_date"),
            F.max(DATE).alias("max_date"),
            half_even(exact_mean(F.col("pm25")), 1).alias("avg_pm25"),
            F.max("us_aqi").cast("int").alias("peak_aqi"),
            F.max("last_ingested_at_utc").alias("last_ingested_at_utc"),
        )
        .where(F.col("hours") > 0)
    )


def status_rows(hourly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``label, value`` facts about the earliest and the peak hour; absent readings have no row."""
    now, peak = F.col("_now"), F.col("_peak")
    facts = [
        ("Source system", now["source_system"]),
        (
            "Coordinates",
            F.concat_ws(
                ", ", *[F.coalesce(fixed(now[c], 2), F.lit("nan")) for c in ("latitude", "longitude")]
            ),
        ),
        ("Peak forecast hour", minute_text(peak[HOUR])),
        ("Peak AQI band", F.when(peak.isNotNull(), aqi_band(peak["us_aqi"])["label"])),
    ]
    if "temperature_c" in hourly.columns:
        facts.append(("Temperature", F.concat(fixed(now["temperature_c"], 1), F.lit(" C"))))
    if "wind_speed_kph" in hourly.columns:
        facts.append(("Wind speed", F.concat(fixed(now["wind_speed_kph"], 1), F.lit(" km/h"))))
    return _facts(_now_and_peak(hourly, keys), keys, facts).where(F.col("value").isNotNull())


def headline_cards(hourly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``label, value`` of the headline figures; absent readings are shown as not available."""
    now, peak = F.col("_now"), F.col("_peak")

    def optional(column: str, digits: int, unit: str) -> Column:
        if column not in hourly.columns:
            return F.lit(NOT_AVAILABLE)
        return F.coalesce(F.concat(fixed(now[column], digits), F.lit(unit)), F.lit(NOT_AVAILABLE))

    facts = [
        ("Next forecast hour", minute_text(now[HOUR])),
        ("Next forecast AQI", now["us_aqi"].cast("int").cast("string")),
        ("Current band", aqi_band(now["us_aqi"])["label"]),
        ("Current advisory", aqi_band(now["us_aqi"])["advisory"]),
        ("Peak AQI in window", peak["us_aqi"].cast("int").cast("string")),
        ("Average PM2.5", fixed(F.col("_pm25"), 1)),
        ("Temperature", optional("temperature_c", 1, " C")),
        ("Relative humidity", optional("relative_humidity", 0, "%")),
        ("Wind speed", optional("wind_speed_kph", 1, " km/h")),
        ("Last ingestion (UTC)", minute_text(F.col("_ingested"))),
    ]
    ingested = "last_ingested_at_utc"
    naive = as_naive_utc(F.col(ingested), dict(hourly.dtypes)[ingested])
    summary = _now_and_peak(
        hourly, keys, exact_mean(F.col("pm25")).alias("_pm25"), F.max(naive).alias("_ingested")
    )
    change = [("Change to the hour after", signed_whole(F.col("aqi_delta")))]
    return _facts(summary, keys, facts).unionByName(
        _facts(current_delta(hourly, keys), keys, change)
    )


def _now_and_peak(hourly: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    """Earliest row and peak row as structs, from one aggregation."""
    row = F.struct(*hourly.columns)
    ties = _ties(hourly)
    place = F.when(F.col(HOUR).isNotNull(), F.struct(HOUR, *ties))
    height = F.when(F.col("us_aqi").isNotNull(), F.struct(-F.col("us_aqi"), F.col(HOUR), *ties))
    return (
        hourly.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.min_by(row, place).alias("_now"),
            F.min_by(row, height).alias("_peak"),
            *more,
        )
        .where(F.col("_rows") > 0)
    )


def _facts(df: DataFrame, keys: Sequence[str], facts: Sequence[tuple[str, Column]]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(n).alias("label"), v.alias("value")) for n, v in facts])
    return df.select(*keys, F.inline(rows))


def display_table(hourly: DataFrame) -> DataFrame:
    """Columns of the record table under their display names."""
    return hourly.select(
        F.col(HOUR).alias("forecast_time_local"),
        "us_aqi",
        "pm25",
        "pm10",
        "temperature_c",
        "relative_humidity",
        "wind_speed_kph",
        F.col("last_ingested_at_utc").alias("last_ingested_utc"),
    )
