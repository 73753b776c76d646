from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from hazeline.operators import serving
from hazeline.plans.views import views
from hazeline.sources.tables import has_mart, has_model, load_hourly, write_model, write_table
from hazeline.specs import DATE, HOUR, HOURLY_COLUMNS, METRIC_LABELS
from tests.conftest import frame, plan_of, rows

DDL = (
    "record_key string, forecast_timestamp_local timestamp_ntz, forecast_date_local date, "
    "pm25 double, pm10 double, us_aqi int, temperature_c double, relative_humidity double, "
    "wind_speed_kph double, last_ingested_at_utc timestamp_ntz, source_system string, "
    "latitude double, longitude double"
)
D24, D25 = date(2026, 3, 24), date(2026, 3, 25)
INGESTED = datetime(2026, 3, 23, 17)


def row(day, hour, aqi, pm25=1.0, pm10=1.0, temp=None, hum=None, wind=None, ingested=INGESTED):
    when = None if day is None else datetime(day.year, day.month, day.day, hour)
    key = f"{day}-{hour}"
    return (key, when, day, pm25, pm10, aqi, temp, hum, wind, ingested, "open-meteo", 13.75, 100.5)


def mart(spark, *data):
    return frame(spark, DDL, *data).repartition(3)


DAYS = [
    row(D24, 0, 70, 28.2, 40.1, 31.0, 60.0, 10.0),
    row(D24, 1, 110, 35.8, 50.2, 33.0, 68.0, 14.0),
    row(D25, 0, 80, 30.0, 44.0, 30.0, 72.0, 12.0),
]


def test_daily_summary(spark):
    daily = serving.daily_summary(mart(spark, *DAYS, row(None, 0, 999)))
    assert daily.columns == [
        DATE,
        "avg_aqi",
        "max_aqi",
        "avg_pm25",
        "avg_pm10",
        "avg_temperature_c",
        "avg_relative_humidity",
        "avg_wind_speed_kph",
    ]
    assert [tuple(r) for r in daily.collect()] == [
        (D24, 90.0, 110, 32.0, 45.2, 32.0, 64.0, 12.0),
        (D25, 80.0, 80, 30.0, 44.0, 30.0, 72.0, 12.0),
    ]


def test_daily_summary_of_nothing_and_of_nulls(spark):
    assert serving.daily_summary(mart(spark)).count() == 0
    only = serving.daily_summary(mart(spark, row(D24, 0, None, None, None))).first()
    assert tuple(only) == (D24, None, None, None, None, None, None, None)


def test_daily_summary_adds_up_before_the_shuffle(spark, tmp_path):
    stored = write_model(mart(spark, *DAYS), str(tmp_path / "m"))
    plan = plan_of(serving.daily_summary(stored))
    assert "partial_sum" in plan and "temperature_c" in plan and "record_key" not in plan


def test_metric_options(spark):
    assert serving.metric_option_map(mart(spark, *DAYS)) == METRIC_LABELS
    assert list(serving.metric_option_map(mart(spark, row(D24, 0, 1)))) == ["us_aqi", "pm25", "pm10"]
    bare = mart(spark, *DAYS).select("us_aqi", "pm10")
    assert serving.metric_option_map(bare) == {"us_aqi": "US AQI", "pm10": "PM10"}


def test_melt_keeps_nulls_and_shows_labels(spark):
    long = serving.melt_metrics(
        mart(spark, row(D24, 0, 70, None)), {"us_aqi": "US AQI", "pm25": "PM2.5"}
    )
    assert long.columns == [HOUR, "value", "metric"]
    when = datetime(2026, 3, 24)
    assert rows(long) == [(when, 70.0, "US AQI"), (when, None, "PM2.5")]
    assert {r["metric"] for r in serving.melt_metrics(mart(spark, *DAYS), {}).collect()} == {"US AQI"}


def test_legacy_mart_is_filled_with_typed_nulls(spark):
    old = mart(spark, DAYS[0]).drop("temperature_c", "relative_humidity", "wind_speed_kph")
    loaded = load_hourly(old)
    assert loaded.columns == list(HOURLY_COLUMNS)
    types = dict(loaded.dtypes)
    assert types["temperature_c"] == "double" and types["last_ingested_at_utc"] == "timestamp"
    first = loaded.first()
    assert first["temperature_c"] is None and first["us_aqi"] == 70
    assert loaded.select(F.unix_seconds("last_ingested_at_utc")).first()[0] == int(
        INGESTED.replace(tzinfo=timezone.utc).timestamp()
    )


def test_loaded_rows_are_in_hour_order(spark):
    loaded = load_hourly(mart(spark, *DAYS[::-1]))
    assert [r["us_aqi"] for r in loaded.collect()] == [70, 110, 80]


def test_date_window_is_inclusive(spark):
    df = mart(spark, *DAYS)
    assert serving.date_window(df, D24, D25).count() == 3
    assert serving.single_date(df, D24).count() == 2
    assert serving.date_window(df, end=D24).count() == 2
    assert serving.date_window(df, start=D25).count() == 1
    assert serving.date_window(df, date(2027, 1, 1)).count() == 0


def test_date_window_prunes_stored_dates(spark, tmp_path):
    stored = write_model(mart(spark, *DAYS), str(tmp_path / "m"))
    plan = plan_of(serving.single_date(stored, D25))
    assert "PartitionFilters: [isnotnull(forecast_date_local" in plan
    assert serving.single_date(stored, D25).first()["us_aqi"] == 80


def test_peak_takes_the_earliest_of_equals(spark):
    df = mart(spark, row(D24, 0, 50), row(D24, 3, 90), row(D24, 2, 90), row(D25, 0, None))
    assert serving.peak_hour(df).first()[HOUR].hour == 2
    assert [r[DATE] for r in serving.peak_hour(df, [DATE]).collect()] == [D24]
    assert serving.peak_hour(mart(spark, row(D24, 0, None))).count() == 0


def test_current_hour_and_delta(spark):
    df = mart(spark, row(D24, 5, 50), row(D24, 3, 90), row(D24, 4, 70), row(None, 0, 1))
    assert serving.current_hour(df).first()["us_aqi"] == 90
    assert tuple(serving.current_delta(df).first()) == (datetime(2026, 3, 24, 3), 90, 20)
    assert serving.current_delta(mart(spark, row(D24, 5, 50))).first()["aqi_delta"] == 0
    assert serving.current_delta(mart(spark)).count() == 0
    by_date = serving.current_delta(mart(spark, *DAYS), [DATE])
    assert {(r[DATE], r["aqi_delta"]) for r in by_date.collect()} == {(D24, -40), (D25, 0)}


def test_map_point_is_the_first_hour(spark):
    df = mart(spark, row(D24, 0, 58), row(D24, 1, 72))
    assert rows(serving.map_points(df)) == [(13.75, 100.5, 58)]
    assert rows(serving.map_points(df, [])) == [(13.75, 100.5, 58)]
    assert serving.map_points(mart(spark)).count() == 0


def test_window_kpis(spark):
    got = serving.window_kpis(mart(spark, *DAYS)).first()
    assert tuple(got) == (3, D24, D25, 31.3, 110, INGESTED)
    assert serving.window_kpis(mart(spark)).count() == 0


def test_status_rows(spark):
    got = {r["label"]: r["value"] for r in serving.status_rows(mart(spark, *DAYS)).collect()}
    assert got == {
        "Source system": "open-meteo",
        "Coordinates": "13.75, 100.50",
        "Peak forecast hour": "2026-03-24 01:00",
        "Peak AQI band": "Unhealthy for Sensitive Groups",
        "Temperature": "31.0 C",
        "Wind speed": "10.0 km/h",
    }
    bare = {r["label"] for r in serving.status_rows(mart(spark, row(D24, 0, 5))).collect()}
    assert bare == set(got) - {"Temperature", "Wind speed"}
    assert serving.status_rows(mart(spark)).count() == 0


def test_headline_cards(spark):
    got = {r["label"]: r["value"] for r in serving.headline_cards(mart(spark, *DAYS)).collect()}
    assert got["Next forecast hour"] == "2026-03-24 00:00"
    assert got["Next forecast AQI"] == "70"
    assert got["Change to the hour after"] == "-40"
    assert got["Current band"] == "Moderate"
    assert got["Peak AQI in window"] == "110"
    assert got["Average PM2.5"] == "31.3"
    assert got["Temperature"] == "31.0 C"
    assert got["Relative humidity"] == "60%"
    assert got["Last ingestion (UTC)"] == "2026-03-23 17:00"
    bare = serving.headline_cards(mart(spark, row(D24, 0, 5)).drop("wind_speed_kph"))
    bare = {r["label"]: r["value"] for r in bare.collect()}
    assert bare["Temperature"] == bare["Wind speed"] == "N/A"


def test_freshness(spark):
    now = datetime(2026, 3, 23, 19, tzinfo=timezone.utc)
    df = mart(
        spark,
        row(D24, 0, 1),
        row(D24, 1, 1, ingested=INGESTED - timedelta(minutes=1)),
        row(D25, 0, 1, ingested=INGESTED - timedelta(minutes=1)),
        row(date(2026, 3, 26), 0, 1, ingested=None),
    )
    got = {r[DATE].day: r["is_stale"] for r in serving.freshness(df, [DATE], now=now).collect()}
    assert got == {24: False, 25: True, 26: True}
    zoned = load_hourly(df)
    assert serving.freshness(zoned, now=now).first()["is_stale"] is False
    assert serving.freshness(df).first()["is_stale"] is True


def test_bands_and_display(spark):
    df = mart(spark, *DAYS)
    assert rows(serving.band_counts(df)) == [("Moderate", 2), ("Unhealthy for Sensitive Groups", 1)]
    assert serving.with_band(df).columns[-3:] == ["band_label", "band_color", "band_advisory"]
    assert serving.display_table(df).columns == [
        "forecast_time_local",
        "us_aqi",
        "pm25",
        "pm10",
        "temperature_c",
        "relative_humidity",
        "wind_speed_kph",
        "last_ingested_utc",
    ]


def test_catalog_mart(spark):
    assert not has_mart(spark)
    try:
        write_table(mart(spark, *DAYS), "fct_aqi_hourly")
        write_table(mart(spark, *DAYS[:2]), "fct_aqi_hourly")
        assert has_mart(spark)
        assert load_hourly(spark.table("fct_aqi_hourly")).count() == 2
    finally:
        spark.sql("drop table if exists fct_aqi_hourly")


@pytest.mark.parametrize("partition_by", [(DATE,), ()])
def test_write_model_replaces(spark, tmp_path, partition_by):
    path = str(tmp_path / "m")
    assert not has_model(spark, path)
    write_model(mart(spark, *DAYS), path, partition_by)
    assert has_model(spark, path)
    again = write_model(mart(spark, *DAYS[:1]), path, partition_by)
    assert again.columns == mart(spark).columns
    assert rows(again) == rows(mart(spark, *DAYS[:1]))


def test_views_of_a_window(spark):
    df = mart(spark, *DAYS)
    got = views(df, D24, D24, now=datetime(2026, 3, 23, 18))
    assert got["hourly"].count() == 2
    assert got["daily"].count() == 1
    assert got["series"].count() == 2 * 6
    assert got["map"].count() == 1
    assert got["freshness"].first()["is_stale"] is False
    assert {r["value"] for r in got["status"].collect()} >= {"open-meteo", "31.0 C"}
    assert [r["forecast_time_local"].hour for r in got["records"].collect()] == [0, 1]
    assert "rangepartitioning" not in plan_of(got["status"])
    # nothing chosen shows the index alone
    assert {r["metric"] for r in views(df, series=[])["series"].collect()} == {"US AQI"}
    chosen = views(df, series=["pm25", "pm10"])["series"]
    assert {r["metric"] for r in chosen.collect()} == {"PM2.5", "PM10"}
    with pytest.raises(ValueError, match="ozone"):
        views(df, series=["ozone"])


def test_answers_do_not_depend_on_the_order_of_rows(spark):
    ddl = "forecast_timestamp_local timestamp_ntz, us_aqi int, latitude double, longitude double"
    data = [(datetime(2026, 3, 24, 0), 400, 13.0, 100.0), (datetime(2026, 3, 24, 0), 10, 12.0, 100.0)]
    for order in (data, data[::-1]):
        df = frame(spark, ddl, *order).coalesce(1)
        assert serving.current_hour(df).first()["us_aqi"] == 10
        assert serving.current_delta(df).first()["us_aqi"] == 10
