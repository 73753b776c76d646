"""What each feed looks like, and the fixed values shared by every layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Reading:
    """One hourly array of a raw document and the typed column it becomes."""

    field: str
    column: str
    type: str


@dataclass(frozen=True)
class Dataset:
    """One feed of hourly forecast documents."""

    name: str
    title: str
    file_prefix: str
    source_system: str
    readings: tuple[Reading, ...]
    needs_a_value: bool

    @property
    def required_fields(self) -> tuple[str, ...]:
        return ("time", *self.reading_fields)

    @property
    def reading_fields(self) -> tuple[str, ...]:
        return tuple(r.field for r in self.readings)

    @property
    def metric_columns(self) -> tuple[str, ...]:
        return tuple(r.column for r in self.readings)

    @property
    def document_schema(self) -> T.StructType:
        """Schema of one raw JSON document; stated, so no inference pass over the data."""
        hourly = T.StructType([T.StructField("time", T.ArrayType(T.StringType()))])
        for field in self.reading_fields:
            hourly.add(field, T.ArrayType(T.DoubleType()))
        return T.StructType(
            [
                T.StructField("latitude", T.DoubleType()),
                T.StructField("longitude", T.DoubleType()),
                T.StructField("hourly", hourly),
            ]
        )


AQI = Dataset(
    name="aqi",
    title="Hourly payload",
    file_prefix="aqi_raw",
    source_system="open-meteo",
    readings=(
        Reading("pm2_5", "pm25", "double"),
        Reading("pm10", "pm10", "double"),
        Reading("us_aqi", "us_aqi", "int"),
    ),
    needs_a_value=True,
)

WEATHER = Dataset(
    name="weather",
    title="Weather payload",
    file_prefix="weather_raw",
    source_system="open-meteo-weather",
    readings=(
        Reading("temperature_2m", "temperature_c", "double"),
        Reading("relative_humidity_2m", "relative_humidity", "double"),
        Reading("wind_speed_10m", "wind_speed_kph", "double"),
    ),
    needs_a_value=False,
)

DATASETS: dict[str, Dataset] = {d.name: d for d in (AQI, WEATHER)}


def dataset(name: str) -> Dataset:
    """The feed of that name; an unknown name is an error."""
    try:
        return DATASETS[name]
    except KeyError:
        raise ValueError(f"Unsupported dataset '{name}'.") from None


HOUR = "forecast_timestamp_local"
DATE = "forecast_date_local"
INGEST_TOKEN = "ingest_time_utc"
FILE = "raw_file_name"

MART_COLUMNS: tuple[str, ...] = (
    "record_key",
    HOUR,
    DATE,
    "pm25",
    "pm10",
    "us_aqi",
    "temperature_c",
    "relative_humidity",
    "wind_speed_kph",
    "last_ingested_at_utc",
    "source_system",
    "latitude",
    "longitude",
)

# Columns handed to the serving layer, in order.
HOURLY_COLUMNS: tuple[str, ...] = MART_COLUMNS[1:]

# Series offered for charts, and the text each is shown under.
METRIC_LABELS: dict[str, str] = {
    "us_aqi": "US AQI",
    "pm25": "PM2.5",
    "pm10": "PM10",
    "temperature_c": "Temperature (C)",
    "relative_humidity": "Relative Humidity (%)",
    "wind_speed_kph": "Wind Speed (km/h)",
}


@dataclass(frozen=True)
class Band:
    label: str
    color: str
    advisory: str


# Inclusive upper bound of each air-quality band, and what is shown for it.
AQI_BANDS: tuple[tuple[int, Band], ...] = (
    (50, Band("Good", "#2E8540", "Air quality is considered satisfactory.")),
    (
        100,
        Band(
            "Moderate",
            "#D4A017",
            "Acceptable for most people, with minor risk for sensitive groups.",
        ),
    ),
    (
        150,
        Band(
            "Unhealthy for Sensitive Groups",
            "#E67E22",
            "Sensitive groups should limit prolonged outdoor exertion.",
        ),
    ),
    (200, Band("Unhealthy", "#C0392B", "Everyone may begin to experience health effects.")),
    (
        300,
        Band(
            "Very Unhealthy",
            "#7D3C98",
            "Health alert conditions; outdoor activity should be reduced.",
        ),
    ),
)
ABOVE_ALL_BANDS = Band(
    "Hazardous", "#6E2C00", "Emergency conditions; avoid outdoor activity where possible."
)
NO_BAND = Band("Unknown", "#5C6770", "AQI data is not available for this selection.")
