from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hazeline.operators.versions import first_rows, latest_version, newest_first, version_history
from hazeline.plans.gold import gold_mart
from hazeline.specs import HOUR, MART_COLUMNS
from tests.conftest import frame, plan_of, rows

H0, H1, H2 = (datetime(2026, 3, 24, h) for h in range(3))
AQI_DDL = (
    "forecast_timestamp_local timestamp_ntz, forecast_date_local date, pm25 double, pm10 double, "
    "us_aqi int, ingest_time_utc string, source_system string, latitude double, longitude double, "
    "raw_file_name string"
)
WEATHER_DDL = AQI_DDL.replace("pm25 double, pm10 double, us_aqi int", (
    "temperature_c double, relative_humidity double, wind_speed_kph double"
))


def aqi_row(hour, token, file, aqi, pm25=1.0):
    return (hour, hour.date(), pm25, 2.0, aqi, token, "open-meteo", 13.75, 100.5, file)


def weather_row(hour, token, file, temperature):
    return (hour, hour.date(), temperature, 60.0, 9.0, token, "open-meteo-weather", 13.75, 100.5, file)


def aqi_frame(spark, *data):
    return frame(spark, AQI_DDL, *data)


def test_newest_ingest_wins_then_file_name(spark):
    df = aqi_frame(
        spark,
        aqi_row(H0, "20260323T170000Z", "a", 1),
        aqi_row(H0, "20260323T180000Z", "a", 2),
        aqi_row(H1, "20260323T180000Z", "a", 3),
        aqi_row(H1, "20260323T180000Z", "b", 4),
    )
    latest = latest_version(df, [HOUR], newest_first())
    assert {(r[HOUR], r["us_aqi"]) for r in latest.collect()} == {(H0, 2), (H1, 4)}


def test_an_hour_stated_twice_in_one_document_has_one_fixed_winner(spark):
    twice = [aqi_row(H0, "20260323T170000Z", "a", n, pm25=float(n)) for n in range(1, 9)]
    winners = set()
    for data in (twice, twice[::-1], twice[3:] + twice[:3]):
        mart = gold_mart(aqi_frame(spark, *data).repartition(3), frame(spark, WEATHER_DDL))
        winners |= {r["us_aqi"] for r in mart.collect()}
    assert winners == {8}


def test_mart_keeps_hours_without_weather(spark):
    mart = gold_mart(
        aqi_frame(
            spark,
            aqi_row(H0, "20260323T170000Z", "a", 10),
            aqi_row(H1, "20260323T170000Z", "a", 20),
        ),
        frame(
            spark,
            WEATHER_DDL,
            weather_row(H1, "20260323T160000Z", "w", 30.0),
            weather_row(H1, "20260323T170001Z", "w", 31.0),
            weather_row(H2, "20260323T170000Z", "w", 32.0),
        ),
    )
    assert mart.columns == list(MART_COLUMNS)
    got = {r[HOUR]: r for r in mart.collect()}
    assert set(got) == {H0, H1}
    assert got[H0]["temperature_c"] is None and got[H0]["source_system"] == "open-meteo"
    assert got[H1]["temperature_c"] == 31.0
    assert got[H1]["last_ingested_at_utc"] == datetime(2026, 3, 23, 17)


def test_mart_by_location_keeps_locations_apart(spark):
    df = aqi_frame(
        spark,
        aqi_row(H0, "20260323T170000Z", "a", 10),
        aqi_row(H0, "20260323T180000Z", "a", 20),
    ).withColumn("site", F.when(F.col("us_aqi") == 10, "x").otherwise("y"))
    weather = frame(spark, WEATHER_DDL, weather_row(H0, "20260323T170000Z", "w", 30.0))
    weather = weather.withColumn("site", F.lit("y"))
    got = {r["site"]: r for r in gold_mart(df, weather, ["site", HOUR]).collect()}
    assert got["x"]["us_aqi"] == 10 and got["x"]["temperature_c"] is None
    assert got["y"]["us_aqi"] == 20 and got["y"]["temperature_c"] == 30.0
    assert got["x"]["record_key"] != got["y"]["record_key"]


def test_empty_input_keeps_the_schema(spark):
    mart = gold_mart(aqi_frame(spark), frame(spark, WEATHER_DDL))
    assert mart.columns == list(MART_COLUMNS) and mart.count() == 0


def test_mart_plan_cuts_groups_before_the_shuffle(spark, tmp_path):
    aqi_frame(spark, aqi_row(H0, "20260323T170000Z", "a", 1)).write.parquet(str(tmp_path / "a"))
    frame(spark, WEATHER_DDL, weather_row(H0, "20260323T170000Z", "w", 1.0)).write.parquet(
        str(tmp_path / "w")
    )
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(
            gold_mart(spark.read.parquet(str(tmp_path / "a")), spark.read.parquet(str(tmp_path / "w")))
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("WindowGroupLimit") == 4
    assert plan.count("Exchange hashpartitioning") == 2
    assert "SinglePartition" not in plan


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows under one key, a third of those being full copies of one row."""
    n = 9_000
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 700).alias("k"),
        F.when(F.col("id") % 9 == 0, F.lit(5)).otherwise(F.col("id") % 1013).alias("a"),
        F.when(F.col("id") % 9 == 0, F.lit(5)).otherwise(F.col("id")).alias("b"),
    )
    return base.withColumn("k", F.when(F.col("k") == 13, F.lit(None)).otherwise(F.col("k")))


def order():
    return [F.col("a").desc(), F.col("b").asc()]


def test_history_of_hot_keys_equals_the_plain_window(spark, skewed):
    plain = version_history(skewed, ["k"], order())
    split = version_history(skewed, ["k"], order(), hot_key_rows=500)
    assert split.columns == plain.columns
    assert rows(split.select("k", "a", "b", "version_rank")) == rows(
        plain.select("k", "a", "b", "version_rank")
    )


def test_history_spreads_a_hot_key_over_slices(spark, skewed):
    split = version_history(skewed, ["k"], order(), hot_key_rows=500)
    hot = split.where("k = -1").select(F.spark_partition_id().alias("p")).distinct().count()
    assert hot > 1


def test_history_with_null_hot_key_and_several_keys(spark):
    df = spark.range(4_000).select(
        F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id") % 5).alias("k"),
        F.lit("x").alias("site"),
        F.col("id").alias("b"),
    )
    newest = [F.col("b").desc()]
    split = version_history(df, ["site", "k"], newest, hot_key_rows=100)
    plain = version_history(df, ["site", "k"], newest)
    assert rows(split) == rows(plain)


def test_first_rows_of_a_skewed_frame(spark, skewed):
    top = first_rows(skewed, ["k"], order(), 2)
    ranked = version_history(skewed, ["k"], order()).where("version_rank <= 2").drop("version_rank")
    assert rows(top) == rows(ranked)
    assert first_rows(skewed, [], order(), 3).count() == 3
