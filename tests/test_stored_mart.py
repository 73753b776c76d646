"""The stored mart: files of two generations, the catalog table, pruned reads."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from hazeline.operators.serving import date_window
from hazeline.plans.queries import QUERIES
from hazeline.sources.tables import MART, has_mart, load_hourly, read_stored, write_model, write_table
from hazeline.specs import DATE, HOUR, HOURLY_COLUMNS, MART_COLUMNS, WEATHER
from tests.compare import DATA
from tests.conftest import frame, rows

DDL = (
    f"record_key string, {HOUR} timestamp_ntz, {DATE} date, pm25 double, pm10 double, us_aqi int, "
    "temperature_c double, relative_humidity double, wind_speed_kph double, "
    "last_ingested_at_utc timestamp_ntz, source_system string, latitude double, longitude double"
)


def hour(day, h=0):
    start = datetime(2026, 3, day, h)
    return (f"{day}-{h}", start, date(2026, 3, day), 1.0, 2.0, 3, 4.0, 5.0, 6.0, start, "s", 13.75, 100.5)


@pytest.fixture(scope="module")
def gold(spark):
    return frame(spark, DDL, *[hour(day, h) for day in range(1, 11) for h in (0, 1)])


def test_old_and_new_files_are_read_together(spark, gold, tmp_path):
    path, older = str(tmp_path / "mart"), F.col(DATE) < F.lit(date(2026, 3, 4))
    write_model(gold.where(older).drop(*WEATHER.metric_columns), path)
    gold.where(~older).write.mode("append").partitionBy(DATE).parquet(path)
    got = load_hourly(read_stored(spark, path))
    assert got.columns == list(HOURLY_COLUMNS)
    assert [t for _, t in got.dtypes] == [
        "timestamp" if n == "last_ingested_at_utc" else t
        for n, t in gold.select(*HOURLY_COLUMNS).dtypes
    ]
    temperature = [(r[DATE].day, r["temperature_c"]) for r in got.collect()]
    assert temperature == [(d, None if d < 4 else 4.0) for d in range(1, 11) for _ in range(2)]


def test_only_old_files(spark, gold, tmp_path):
    write_model(gold.drop(*WEATHER.metric_columns), str(tmp_path / "mart"))
    got = load_hourly(read_stored(spark, str(tmp_path / "mart")))
    assert got.count() == 20 and got.where("wind_speed_kph is not null").count() == 0


def test_catalog_table_is_found_replaced_and_pruned(spark, gold, tmp_path):
    name = "stored_mart_of_a_test"
    assert not has_mart(spark, name)
    write_table(gold.limit(1), name, path=str(tmp_path / "one"))
    write_table(gold, name, path=str(tmp_path / "two"))
    assert has_mart(spark, name)
    table = spark.table(name)
    assert rows(table.select(*MART_COLUMNS)) == rows(gold)
    partitions = {r[0] for r in spark.sql(f"show partitions {name}").collect()}
    assert partitions == {f"{DATE}=2026-03-{d:02d}" for d in range(1, 11)}
    spark.sql(f"drop table {name}")
    assert not has_mart(spark, name)


def test_catalog_query_leaves_the_mart_alone(spark, gold):
    small = DATA / "sf0.001"
    if not small.exists():
        pytest.skip("no test data here")
    try:
        write_table(gold.limit(1), MART)
        assert QUERIES["catalog_mart"](spark, str(small)).count() > 1
        assert spark.table(MART).count() == 1
    finally:
        spark.sql(f"drop table if exists {MART}")
    QUERIES["catalog_mart"](spark, str(small))
    assert not has_mart(spark)


def test_a_window_reads_only_the_files_of_its_dates(spark, gold, tmp_path):
    stored = write_model(gold, str(tmp_path / "mart"))
    window = date_window(stored, date(2026, 3, 4), date(2026, 3, 6))
    everywhere = len(stored.inputFiles())
    inside = window.select("_metadata.file_path").distinct().count()
    assert everywhere >= 10 and files_read(stored) == everywhere
    assert files_read(window) == inside < everywhere


def files_read(df) -> int:
    """Files the scan opened, as counted while it ran."""
    execution = df._jdf.queryExecution()
    df._jdf.queryExecution().executedPlan().executeCollect()
    plan = execution.executedPlan()
    scan = plan.collectLeaves().head()
    return int(scan.metrics().apply("numFiles").value())
