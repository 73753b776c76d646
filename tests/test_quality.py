from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hazeline.operators import quality
from hazeline.specs import HOUR
from tests.conftest import frame, rows

START = datetime(2024, 1, 1)
PREVIOUS = f"previous_{HOUR}"


def hours_frame(spark, offsets):
    data = [(None if m is None else START + timedelta(minutes=m),) for m in offsets]
    return frame(spark, f"{HOUR} timestamp_ntz", *data).repartition(3)


def naive_gaps(offsets):
    times = sorted(START + timedelta(minutes=m) for m in offsets if m is not None)

    def hour(t):
        return t.replace(minute=0)

    return sorted(
        (b, a) for a, b in zip(times, times[1:]) if hour(b) - hour(a) != timedelta(hours=1)
    )


@pytest.mark.parametrize(
    "offsets",
    [
        [],
        [0],
        [0, 60, 120],
        [0, 120],
        [22 * 60, 23 * 60, 25 * 60],
        [23 * 60, 24 * 60],
        [0, 0, 60],
        [59, 61],
        [10, 50],
        [0, 3 * 24 * 60, None, None],
        [0, 0, 0, 180, 180],
    ],
)
def test_gaps(spark, offsets):
    assert rows(quality.hourly_gaps(hours_frame(spark, offsets))) == naive_gaps(offsets)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 4 * 24 * 2).map(lambda n: n * 30), max_size=40))
def test_gaps_equal_the_naive_scan(spark, offsets):
    assert rows(quality.hourly_gaps(hours_frame(spark, offsets))) == naive_gaps(offsets)


def test_repeats_are_whole_when_they_span_chunks(spark, monkeypatch):
    monkeypatch.setattr(quality, "REPEAT_CHUNK", 7)
    for n in (1, 2, 8, 9, 15, 16):
        assert rows(quality.hourly_gaps(hours_frame(spark, [0] * n + [180]))) == naive_gaps([0] * n + [180])


def test_gaps_by_key(spark):
    data = [("a", START), ("a", START + timedelta(hours=1)), ("b", START), ("b", START + timedelta(hours=5))]
    df = frame(spark, f"site string, {HOUR} timestamp_ntz", *data)
    gaps = quality.hourly_gaps(df, keys=["site"])
    assert gaps.columns == ["site", HOUR, PREVIOUS]
    assert rows(gaps) == [("b", START + timedelta(hours=5), START)]


MART_DDL = (
    "record_key string, forecast_timestamp_local timestamp_ntz, last_ingested_at_utc timestamp_ntz, "
    "pm25 double, pm10 double, us_aqi int, temperature_c double, relative_humidity double, "
    "wind_speed_kph double"
)
STAGED_DDL = (
    "forecast_timestamp_local timestamp_ntz, ingest_time_utc string, source_system string, "
    "raw_file_name string"
)


def mart_row(key="k", hour=0, **changes):
    row = {
        "record_key": key,
        "forecast_timestamp_local": START + timedelta(hours=hour),
        "last_ingested_at_utc": START,
        "pm25": 1.0,
        "pm10": 2.0,
        "us_aqi": 30,
        "temperature_c": 30.0,
        "relative_humidity": 50.0,
        "wind_speed_kph": 5.0,
        **changes,
    }
    return tuple(row.values())


def outcome(report):
    return {r["check_name"]: r["failing_rows"] for r in report.collect()}


def staged(spark, system, *more):
    return frame(spark, STAGED_DDL, (START, "t", system, "f"), *more)


def report(spark, mart_rows, aqi=None, weather=None):
    return quality.dq_report(
        aqi if aqi is not None else staged(spark, "open-meteo"),
        weather if weather is not None else staged(spark, "open-meteo-weather"),
        frame(spark, MART_DDL, *mart_rows),
    )


def test_a_sound_mart_passes_all_21_checks(spark):
    result = report(spark, [mart_row("a", 0), mart_row("b", 1)])
    assert result.count() == 21
    assert set(outcome(result).values()) == {0}
    quality.require_passing(result)


def test_an_empty_mart_still_lists_every_check(spark):
    result = report(spark, [])
    assert result.count() == 21 and set(outcome(result).values()) == {0}


def test_each_check_finds_its_defect(spark):
    mart = [
        mart_row("a", 0),
        mart_row("a", 1, pm25=-1.0),
        mart_row(None, 2, pm10=-0.5),
        mart_row(None, 2, us_aqi=501, pm25=None),
        mart_row("d", 4, us_aqi=-1),
        mart_row("e", 5, temperature_c=None, relative_humidity=None, wind_speed_kph=None),
        mart_row("f", 6, relative_humidity=100.5, wind_speed_kph=-1.0),
        mart_row("g", 7, relative_humidity=-0.5, last_ingested_at_utc=None, us_aqi=None),
    ]
    aqi = staged(spark, "open-meteo", (None, None, None, None), (START, "t", "elsewhere", "f"))
    found = outcome(report(spark, mart, aqi=aqi))
    failing = {k: v for k, v in found.items() if v}
    assert failing == {
        "stg_aqi_hourly.forecast_timestamp_local.not_null": 1,
        "stg_aqi_hourly.ingest_time_utc.not_null": 1,
        "stg_aqi_hourly.source_system.not_null": 1,
        "stg_aqi_hourly.raw_file_name.not_null": 1,
        "stg_aqi_hourly.source_system.accepted_values": 1,
        "fct_aqi_hourly.record_key.not_null": 2,
        "fct_aqi_hourly.last_ingested_at_utc.not_null": 1,
        "fct_aqi_hourly.temperature_c.not_null": 1,
        "fct_aqi_hourly.relative_humidity.not_null": 1,
        "fct_aqi_hourly.wind_speed_kph.not_null": 1,
        # nulls do not count as repeats
        "fct_aqi_hourly.record_key.unique": 1,
        "fct_aqi_hourly.forecast_timestamp_local.unique": 1,
        "valid_metric_ranges": 4,
        "valid_weather_ranges": 2,
        "no_missing_hourly_gaps": 2,
    }


def test_require_passing_names_the_failures(spark):
    with pytest.raises(quality.DataQualityError, match=r"valid_metric_ranges \(1\)"):
        quality.require_passing(report(spark, [mart_row(pm25=-3.0)]))


def test_unique_counts_repeated_values(spark):
    df = frame(spark, "a string, b int", ("x", 1), ("x", 2), ("y", 2), (None, 3), (None, 4))
    assert outcome(quality.unique_failures(df, ["a", "b"], "t")) == {"t.a.unique": 1, "t.b.unique": 1}


def test_unique_over_groups_of_columns(spark):
    data = (("x", "1|", "a"), ("x", "1|", "b"), ("x|1", "|", "a"), ("x", None, "a"), ("x", None, "a"))
    df = frame(spark, "a string, b string, c string", *data)
    found = outcome(quality.unique_failures(df, [["a", "b"], ["a", "b", "c"], "c"], "t"))
    assert found == {"t.a+b.unique": 1, "t.a+b+c.unique": 0, "t.c.unique": 1}


def test_uniqueness_tells_instants_of_a_repeated_hour_apart(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql(
            "select explode(array(timestamp'2024-11-03 05:30:00Z', timestamp'2024-11-03 06:30:00Z')) as t"
        )
        failing = {r[0]: r[1] for r in quality.unique_failures(df, ["t"], "m").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert failing == {"m.t.unique": 0}
