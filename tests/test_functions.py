from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from hazeline.functions import clock, numbers, paths
from hazeline.functions.bands import aqi_band
from hazeline.specs import dataset
from tests.conftest import frame


def one(spark, column, ddl="x int", *row):
    return frame(spark, ddl, row or (0,)).select(column.alias("out")).first()["out"]


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "feed, prefix, expected",
    [
        ("aqi", "city_aqi_raw", "raw/aqi/ingest_date=2026-03-24/city_aqi_raw_20260324T123456Z.json"),
        (
            "weather",
            "city_weather_raw",
            "raw/weather/ingest_date=2026-03-24/city_weather_raw_20260324T123456Z.json",
        ),
        ("aqi", None, "raw/aqi/ingest_date=2026-03-24/aqi_raw_20260324T123456Z.json"),
    ],
)
def test_object_path_is_partitioned_by_ingest_date(spark, feed, prefix, expected):
    assert one(spark, paths.object_path(ts("2026-03-24 12:34:56.789"), feed, prefix)) == expected


def test_object_path_rejects_unknown_feed():
    with pytest.raises(ValueError, match="Unsupported dataset 'pollen'"):
        paths.object_path(F.lit(None), "pollen")
    with pytest.raises(ValueError):
        dataset("pollen")


@pytest.mark.parametrize(
    "path, token",
    [
        ("raw/aqi/ingest_date=2026-03-24/city_aqi_raw_20260324T123456Z.json", "20260324T123456Z"),
        ("file:/srv/my_raw_folder/city_aqi_raw_20260324T123456Z.json", "20260324T123456Z"),
        ("raw/aqi/other.json", ""),
        (None, None),
    ],
)
def test_ingest_token(spark, path, token):
    assert one(spark, paths.ingest_token(F.col("p")), "p string", path) == token


def test_ingest_text_and_back(spark):
    when = ts("0987-01-02 03:04:05.6")
    assert one(spark, clock.ingest_text(when)) == "09870102T030405Z"
    assert one(spark, clock.ingest_instant(clock.ingest_text(when))) == datetime(987, 1, 2, 3, 4, 5)
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        one(spark, clock.ingest_instant(F.lit("2026-03-24")))


@pytest.mark.parametrize(
    "a, b, hours",
    [
        ("2024-01-01 00:59", "2024-01-01 01:01", 1),
        ("2024-01-01 00:01", "2024-01-01 00:59", 0),
        ("2024-01-01 23:30", "2024-01-02 00:00", 1),
        ("2024-01-02 00:00", "2024-01-01 23:59:59.999999", -1),
        ("1969-12-31 23:59:59.5", "1970-01-01 00:00", 1),
        ("2024-01-01 00:00", None, None),
    ],
)
def test_hours_are_counted_by_boundary(spark, a, b, hours):
    assert one(spark, clock.hours_crossed(ts(a), ts(b))) == hours


def test_hour_floor_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 does not exist there on that day
        when = ts("2024-03-10 02:30:15.25")
        assert one(spark, clock.hour_floor(when)) == datetime(2024, 3, 10, 2)
        assert one(spark, clock.ingest_text(when)) == "20240310T023015Z"
        assert one(spark, clock.document_time(when)) == "2024-03-10T02:30"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "value, nearest",
    [(42.5, 42), (43.5, 44), (42.7, 43), (-0.5, 0), (-1.5, -2), (None, None)],
)
def test_whole_rounds_half_even(spark, value, nearest):
    assert one(spark, numbers.whole(F.col("v")), "v double", value) == nearest


@pytest.mark.parametrize("value", [0.15, 0.25, 0.35, 45.15, 2.675, -0.04, 12345.678, 0.0])
@pytest.mark.parametrize("digits", [0, 1, 2])
def test_fixed_equals_python_formatting(spark, value, digits):
    assert one(spark, numbers.fixed(F.col("v"), digits), "v double", value) == f"{value:.{digits}f}"


@pytest.mark.parametrize("value", [-12, -1, 0, 1, 25])
def test_signed_whole(spark, value):
    assert one(spark, numbers.signed_whole(F.col("v")), "v int", value) == f"{value:+.0f}"


def test_exact_mean_skips_null_and_nan(spark):
    df = frame(spark, "v double", (1.5,), (None,), (float("nan"),), (-2.25,), (1e9,))
    assert df.agg(numbers.exact_mean(F.col("v"))).first()[0] == (1.5 - 2.25 + 1e9) / 3
    assert df.where("v is null").agg(numbers.exact_mean(F.col("v"))).first()[0] is None
    whole = frame(spark, "v int", (70,), (111,))
    assert whole.agg(numbers.exact_mean(F.col("v"))).first()[0] == 90.5


def test_exact_mean_of_large_sums(spark):
    # beyond what a double, and then a long of millionths, can add up exactly
    for value, n in ((4e9 + 0.1, 1000), (8e12, 5000)):
        df = spark.range(n).select((F.lit(value) + F.col("id") % 2).alias("v"))
        got = df.agg(numbers.exact_mean(F.col("v"))).first()[0]
        assert got == pytest.approx(value + 0.5, rel=1e-15)
    df = spark.range(4).select((F.col("id") * -1e9 - 0.25).alias("v"))
    assert df.agg(numbers.exact_mean(F.col("v"))).first()[0] == -1.5e9 - 0.25


def test_exact_mean_does_not_depend_on_row_order(spark):
    values = spark.range(20_000).select(((F.col("id") * 7919 % 100_003) / 100).alias("v"))
    means = {
        values.repartition(n).agg(numbers.exact_mean(F.col("v"))).first()[0] for n in (1, 3, 8, 17)
    }
    assert len(means) == 1


@pytest.mark.parametrize(
    "value, label",
    [
        (42, "Good"),
        (50, "Good"),
        (50.1, "Moderate"),
        (51, "Moderate"),
        (100, "Moderate"),
        (101, "Unhealthy for Sensitive Groups"),
        (125, "Unhealthy for Sensitive Groups"),
        (150, "Unhealthy for Sensitive Groups"),
        (151, "Unhealthy"),
        (200, "Unhealthy"),
        (201, "Very Unhealthy"),
        (300, "Very Unhealthy"),
        (301, "Hazardous"),
        (320, "Hazardous"),
        (-5, "Good"),
        (None, "Unknown"),
        (float("nan"), "Unknown"),
    ],
)
def test_bands(spark, value, label):
    number = None if value is None else float(value)
    band = one(spark, aqi_band(F.col("v")), "v double", number)
    assert band["label"] == label and band["color"].startswith("#") and band["advisory"]


def test_staleness_boundary(spark):
    now = datetime(2026, 3, 24, 12, tzinfo=timezone.utc)

    def stale(text, reference=now):
        reference = clock.naive_literal(reference)
        return one(spark, clock.is_stale(ts(text), reference, timedelta(hours=2)))

    assert not stale("2026-03-24 10:00:00")
    assert stale("2026-03-24 09:59:59")
    assert stale("2026-03-24 09:59:00")
    assert stale(None)
    seven_ahead = now.astimezone(timezone(timedelta(hours=7)))
    assert not stale("2026-03-24 10:00:00", seven_ahead)


# In New York the hour from 05:00 to 06:00 UTC that day is shown again an hour later.
@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
@pytest.mark.parametrize(
    "text",
    ["2026-03-24 10:00:00", "2024-11-03 05:30:00.000001", "2024-11-03 06:30:00", "1969-12-31 23:59:59.5"],
)
def test_naive_and_zoned_utc_times_agree(spark, zone, text):
    expected = datetime.fromisoformat(text)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        naive, zoned = ts(text), F.lit(text + "Z").cast("timestamp")
        apart = F.unix_micros(clock.as_utc(naive, "timestamp_ntz")) - F.unix_micros(zoned)
        assert one(spark, apart) == 0
        assert one(spark, clock.as_naive_utc(zoned, "timestamp")) == expected
        assert one(spark, clock.as_naive_utc(naive, "timestamp_ntz")) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_record_key_is_md5_of_the_joined_text(spark):
    import hashlib

    key = one(spark, paths.record_key(ts("2026-03-24 00:00"), F.lit("20260323T170000Z")))
    assert key == hashlib.md5(b"2026-03-24 00:00:00|20260323T170000Z").hexdigest()
    assert one(spark, paths.record_key(F.lit("a"), F.lit(None).cast("string"))) is None


@pytest.mark.parametrize(
    "values, mean",
    [((1.0, float("inf")), float("inf")), ((1e13, 3e13), 2e13), ((1e-8, 3e-8), 2e-8)],
)
def test_exact_mean_of_values_millionths_do_not_hold(spark, values, mean):
    df = frame(spark, "v double", *[(v,) for v in values])
    assert df.agg(numbers.exact_mean(F.col("v"))).first()[0] == pytest.approx(mean)
