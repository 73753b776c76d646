from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from hazeline.operators.quality import DataQualityError
from hazeline.operators.validation import valid_documents
from hazeline.plans.build import build
from hazeline.plans.gold import gold_mart
from hazeline.plans.silver import silver, silver_from_landing
from hazeline.sources import bronze
from hazeline.sources.tables import load_hourly, write_model
from hazeline.specs import AQI, FILE, HOUR, MART_COLUMNS, WEATHER
from hazeline.streaming.silver import current_rows, stream_silver
from tests.conftest import frame, plan_of, rows

LANDING_DDL = (
    "raw_file_name string, payload string, landed_at_utc timestamp_ntz, dataset string, ingest_date date"
)
# Odd spacing on purpose: it must come back as it was.
VERBATIM = (
    '{"latitude":13.75,"longitude":100.5,\n  "hourly":{"time":["2026-03-24T00:00","2026-03-24T01:00"],'
    '"pm2_5":[12.3, null],"pm10":[20.5,21],"us_aqi":[42,42.5]}}  '
)


def weather_text(temperature=31.5):
    hourly = {
        "time": ["2026-03-24T00:00", "2026-03-24T01:00"],
        "temperature_2m": [temperature, temperature + 1],
        "relative_humidity_2m": [63, 64],
        "wind_speed_10m": [12.1, 12.2],
    }
    return json.dumps({"latitude": 13.75, "longitude": 100.5, "hourly": hourly})


def path(feed, token):
    return f"raw/{feed.name}/ingest_date=2026-03-24/city_{feed.file_prefix}_{token}.json"


def doc(feed, token, payload, landed=datetime(2026, 3, 24, 12)):
    return (path(feed, token), payload, landed, feed.name, date(2026, 3, 24))


@pytest.fixture
def tree(tmp_path):
    """A tree of one JSON file per document."""
    for feed, token, text in (
        (AQI, "20260324T123456Z", VERBATIM),
        (AQI, "20260324T133456Z", VERBATIM.replace("42,", "43,")),
        (WEATHER, "20260324T123456Z", weather_text()),
    ):
        file = tmp_path / path(feed, token)
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(text)
    (tmp_path / "raw/aqi/ingest_date=2026-03-24/notes.txt").write_text("not a document")
    return tmp_path / "raw"


def test_tree_scan_explodes_with_lineage(spark, tree):
    docs = bronze.read_document_tree(spark, str(tree / "aqi"), AQI)
    assert docs.count() == 2 and "ingest_date" in docs.columns
    out = silver(docs, AQI)
    got = out.where("ingest_time_utc = '20260324T123456Z'").orderBy(HOUR).collect()
    assert [(r["pm25"], r["pm10"], r["us_aqi"]) for r in got] == [(12.3, 20.5, 42), (None, 21.0, 42)]
    assert got[0][FILE].endswith("city_aqi_raw_20260324T123456Z.json")
    assert out.columns == [
        "forecast_timestamp_local",
        "forecast_date_local",
        "pm25",
        "pm10",
        "us_aqi",
        "ingest_time_utc",
        "source_system",
        "latitude",
        "longitude",
        "raw_file_name",
    ]


def test_tree_scan_prunes_ingest_dates(spark, tree):
    docs = bronze.read_document_tree(spark, str(tree / "aqi"), AQI)
    plan = plan_of(docs.where("ingest_date = date '2026-03-24'"))
    assert "PartitionFilters: [isnotnull(ingest_date" in plan


def test_tree_scan_at_any_depth(spark, tree):
    odd = tree / "aqi/by-hand/march/city_aqi_raw_20260324T153456Z.json"
    odd.parent.mkdir(parents=True)
    odd.write_text(VERBATIM)
    docs = bronze.read_document_tree(spark, str(tree / "aqi"), AQI, any_depth=True)
    tokens = {r[0] for r in silver(docs, AQI).select("ingest_time_utc").collect()}
    assert tokens == {"20260324T123456Z", "20260324T133456Z", "20260324T153456Z"}


def test_a_broken_file_is_an_error(spark, tree):
    broken = tree / "aqi/ingest_date=2026-03-24/city_aqi_raw_20260324T143456Z.json"
    broken.write_text('{"latitude": ')
    with pytest.raises(Exception, match="FAILFAST|MALFORMED|FAILED_READ_FILE"):
        bronze.read_document_tree(spark, str(tree / "aqi"), AQI).collect()


def test_texts_and_bytes_are_verbatim(spark, tree):
    texts = bronze.read_document_texts(spark, str(tree / "aqi"))
    assert VERBATIM in {r["payload"] for r in texts.collect()}
    assert valid_documents(texts, AQI).count() == 2
    contents = bronze.read_document_bytes(spark, str(tree / "aqi")).select("content").collect()
    assert VERBATIM.encode() in {bytes(r["content"]) for r in contents}


def test_list_files(spark, tree, tmp_path):
    listed = bronze.list_files(spark, str(tree))
    names = [r["path"].rsplit("/", 1)[1] for r in listed.collect()]
    assert len(names) == 4 and [r["path"] for r in listed.collect()] == sorted(
        r["path"] for r in listed.collect()
    )
    assert "content" not in plan_of(listed).split("ReadSchema")[1]
    assert bronze.list_files(spark, str(tmp_path / "nowhere")).collect() == []


def test_landing_appends_verbatim(spark, tmp_path):
    root = str(tmp_path / "landing")
    first = frame(spark, LANDING_DDL, doc(AQI, "20260324T123456Z", VERBATIM))
    second = frame(spark, LANDING_DDL, doc(WEATHER, "20260324T123456Z", weather_text()))
    bronze.land_documents(first, root)
    bronze.land_documents(second, root)
    landed = bronze.read_landing(spark, root)
    assert rows(landed) == rows(first.unionByName(second))
    only = bronze.read_landing(spark, root, AQI)
    assert only.first()["payload"] == VERBATIM
    assert "PartitionFilters: [isnotnull(dataset" in plan_of(only)


def test_documents_without_a_path_are_all_kept(spark):
    landed = frame(
        spark,
        LANDING_DDL,
        (None, "n1", datetime(2026, 3, 24, 12), "aqi", date(2026, 3, 24)),
        (None, "n2", datetime(2026, 3, 24, 12), "aqi", date(2026, 3, 24)),
        doc(AQI, "1", "old", datetime(2026, 3, 24, 12)),
        doc(AQI, "1", "new", datetime(2026, 3, 24, 13)),
    )
    assert {r["payload"] for r in bronze.latest_landing(landed).collect()} == {"n1", "n2", "new"}


def test_a_tree_is_landed_with_its_paths(spark, tmp_path):
    folder = tmp_path / "tree" / "raw" / "aqi" / "ingest_date=2026-03-24"
    folder.mkdir(parents=True)
    (folder / "aqi_raw_20260324T123456Z.json").write_text(VERBATIM)
    bronze.land_tree(spark, str(tmp_path / "tree"), str(tmp_path / "landing"), AQI)
    got = bronze.read_landing(spark, str(tmp_path / "landing"), AQI).first()
    assert got["payload"] == VERBATIM and got["ingest_date"] == date(2026, 3, 24)
    assert got[bronze.FILE].endswith("aqi_raw_20260324T123456Z.json")


def test_landing_again_replaces(spark):
    landed = frame(
        spark,
        LANDING_DDL,
        doc(AQI, "1", "old", datetime(2026, 3, 24, 12)),
        doc(AQI, "1", "new", datetime(2026, 3, 24, 13)),
        doc(AQI, "2", "only"),
    )
    assert {r["payload"] for r in bronze.latest_landing(landed).collect()} == {"new", "only"}


def test_objects_are_listed_by_prefix(spark):
    landed = frame(
        spark,
        LANDING_DDL,
        doc(WEATHER, "2", "x"),
        doc(WEATHER, "1", "x"),
        doc(WEATHER, "1", "y"),
        doc(AQI, "1", "x"),
    )
    assert [r[0] for r in bronze.list_objects(landed, "raw/weather/").collect()] == [
        path(WEATHER, "1"),
        path(WEATHER, "2"),
    ]
    assert bronze.list_objects(landed).count() == 3
    assert bronze.list_objects(landed, "raw/pollen/").count() == 0


def parsed(spark, *payloads):
    data = [(f"a_raw_{i}.json", p) for i, p in enumerate(payloads)]
    docs = frame(spark, "raw_file_name string, payload string", *data)
    return bronze.parse_documents(docs, AQI)


def test_ragged_and_absent_arrays_are_padded(spark):
    docs = parsed(
        spark,
        '{"hourly":{"time":["2026-03-24T00:00","2026-03-24T01:00"],"pm2_5":[1],"us_aqi":[5,6]}}',
        '{"hourly":{"time":[],"pm2_5":[],"pm10":[],"us_aqi":[]}}',
        '{"hourly":null}',
        "{}",
    )
    got = silver(docs, AQI).orderBy(HOUR).collect()
    assert [(r["pm25"], r["pm10"], r["us_aqi"]) for r in got] == [(1.0, None, 5), (None, None, 6)]


def test_a_reading_that_is_no_number_is_an_error(spark):
    docs = parsed(spark, '{"hourly":{"time":["2026-03-24T00:00"],"pm2_5":["x"],"pm10":[1],"us_aqi":[5]}}')
    with pytest.raises(Exception, match="document does not fit its schema: a_raw_0.json"):
        silver(docs, AQI).collect()


def test_checked_and_plain_parsing_agree(spark):
    docs = frame(
        spark,
        "raw_file_name string, payload string",
        ("a_raw_1.json", VERBATIM),
        ("a_raw_2.json", VERBATIM.replace("20.5,21", "-0.1e-3, 7")),
        ("a_raw_3.json", '{"hourly":{"time":["2026-03-24T00:00"],"pm2_5":null,"pm10":[1],"us_aqi":[2]}}'),
    )
    plain = silver(bronze.parse_documents(docs, AQI), AQI)
    assert rows(silver_from_landing(docs, AQI)) == rows(plain)
    assert plain.count() == 5
    odd = docs.selectExpr("raw_file_name", "replace(payload, '12.3', '\"x\"') as payload")
    passed = silver(bronze.parse_documents(docs.where("raw_file_name = 'a_raw_3.json'"), AQI), AQI)
    assert rows(silver_from_landing(odd, AQI)) == rows(passed)


def test_bad_time_text_is_an_error(spark):
    docs = parsed(spark, '{"hourly":{"time":["soon"],"pm2_5":[1],"pm10":[1],"us_aqi":[5]}}')
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        silver(docs, AQI).collect()


def land_good(spark, root):
    bronze.land_documents(
        frame(
            spark,
            LANDING_DDL,
            doc(AQI, "20260324T123456Z", VERBATIM),
            doc(AQI, "20260324T133456Z", VERBATIM.replace("[42,", "[77,")),
            doc(AQI, "20260324T143456Z", '{"hourly": {}}'),
            doc(WEATHER, "20260324T123456Z", weather_text()),
        ),
        root,
    )


def test_build_from_landing_to_mart(spark, tmp_path):
    root, warehouse = str(tmp_path / "landing"), str(tmp_path / "warehouse")
    land_good(spark, root)
    for _ in range(2):  # a rebuild replaces, it does not add
        result = build(spark, root, warehouse)
        hourly = load_hourly(result.mart).collect()
        assert [(r["us_aqi"], r["temperature_c"]) for r in hourly] == [(77, 31.5), (42, 32.5)]
        assert result.report.count() == 21 and result.report.where("not passed").count() == 0
        bad = spark.read.parquet(f"{warehouse}/quarantine_aqi")
        assert [r["verdict"] for r in bad.collect()] == ["missing_hourly"]


def test_build_of_several_locations(spark, tmp_path):
    root, warehouse = str(tmp_path / "landing"), str(tmp_path / "warehouse")
    land_good(spark, root)
    far = {"13.75": "51.5", "100.5": "0.25"}

    def moved(text):
        for here, there in far.items():
            text = text.replace(here, there)
        return text

    bronze.land_documents(
        frame(
            spark,
            LANDING_DDL,
            doc(AQI, "20260324T153456Z", moved(VERBATIM)),
            doc(WEATHER, "20260324T153456Z", moved(weather_text(7.5))),
        ),
        root,
    )
    result = build(spark, root, warehouse, ["latitude", "longitude"])
    got = result.mart.select("latitude", "us_aqi", "temperature_c").collect()
    assert sorted(tuple(r) for r in got) == [
        (13.75, 42, 32.5),
        (13.75, 77, 31.5),
        (51.5, 42, 7.5),
        (51.5, 42, 8.5),
    ]
    assert result.mart.columns == list(MART_COLUMNS)
    assert result.report.where("not passed").count() == 0


def test_build_replaces_all_dates_in_a_dynamic_overwrite_session(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for day in ("2026-03-24", "2026-03-25"):
            stored = write_model(
                spark.sql(f"select 1 as a, date '{day}' as d"), path, ["d"]
            )
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [str(r["d"]) for r in stored.collect()] == ["2026-03-25"]


def test_build_stops_on_failed_checks(spark, tmp_path):
    root, warehouse = str(tmp_path / "landing"), str(tmp_path / "warehouse")
    bronze.land_documents(
        frame(
            spark,
            LANDING_DDL,
            doc(AQI, "20260324T123456Z", VERBATIM.replace("12.3", "-12.3")),
            doc(WEATHER, "20260324T123456Z", weather_text()),
        ),
        root,
    )
    with pytest.raises(DataQualityError, match="valid_metric_ranges"):
        build(spark, root, warehouse)


def test_stream_picks_up_only_new_documents(spark, tmp_path):
    root, target, state = (str(tmp_path / n) for n in ("landing", "silver", "state"))

    def run():
        stream_silver(spark, root, target, state, AQI, max_bytes=1 << 26).awaitTermination()
        return spark.read.parquet(target).drop("ingest_date", "landed_at_utc")

    land_good(spark, root)
    assert run().count() == 4
    bronze.land_documents(frame(spark, LANDING_DDL, doc(AQI, "20260324T153456Z", VERBATIM)), root)
    streamed = run()
    assert streamed.count() == 6
    assert run().count() == 6
    batch = silver_from_landing(bronze.read_landing(spark, root, AQI), AQI)
    assert rows(streamed.select(batch.columns)) == rows(batch)


def test_streamed_rows_of_a_file_landed_again_equal_the_batch(spark, tmp_path):
    root, target, state = (str(tmp_path / n) for n in ("landing", "silver", "state"))
    for hour, text in ((12, VERBATIM.replace("[42,", "[90,")), (13, VERBATIM.replace("[42,", "[40,"))):
        again = doc(AQI, "20260324T123456Z", text, datetime(2026, 3, 24, hour))
        bronze.land_documents(frame(spark, LANDING_DDL, again), root)
        stream_silver(spark, root, target, state, AQI).awaitTermination()
    weather = frame(spark, LANDING_DDL, doc(WEATHER, "20260324T123456Z", weather_text()))
    weather = silver_from_landing(weather, WEATHER)
    newest = bronze.latest_landing(bronze.read_landing(spark, root, AQI))
    batch = gold_mart(silver_from_landing(newest, AQI), weather)
    streamed = spark.read.parquet(target)
    assert rows(gold_mart(current_rows(streamed), weather)) == rows(batch)
    assert rows(gold_mart(streamed, weather)) == rows(batch)
    assert batch.agg({"us_aqi": "min"}).first()[0] == 40


def test_last_landings_are_found_without_sorting_payloads(spark, tmp_path):
    noon, one = datetime(2026, 3, 24, 12), datetime(2026, 3, 24, 13)
    day = noon.date()
    docs = [
        ("a", "old", noon, "aqi", day),
        *[("a", "new", one, "aqi", day)] * 3,
        ("b", "only", noon, "aqi", day),
        ("c", "x", noon, "aqi", day),
        ("c", None, one, "weather", day),
        (None, "n", noon, "aqi", day),
        (None, "n", noon, "aqi", day),
    ]
    root = str(tmp_path / "landing")
    bronze.land_documents(spark.createDataFrame(docs, bronze.LANDING_SCHEMA), root)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        last = bronze.latest_landing(bronze.read_landing(spark, root))
        assert "SortMergeJoin" not in plan_of(last)
        assert rows(last.select("raw_file_name", "payload")) == rows(
            spark.createDataFrame(
                [("a", "new"), ("b", "only"), ("c", None), (None, "n"), (None, "n")],
                "raw_file_name string, payload string",
            )
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    first = bronze.latest_landing(bronze.read_landing(spark, root), [F.col("landed_at_utc").asc()])
    assert rows(first.where("raw_file_name in ('a', 'c')").select("payload")) == [("old",), ("x",)]
