from __future__ import annotations

import json

import pytest

from hazeline.operators.validation import quarantine, valid_documents, with_verdict
from hazeline.specs import AQI, WEATHER
from tests.conftest import frame

T = "2026-03-24T00:00"


def aqi(**changes):
    hourly = {"time": [T], "pm2_5": [12.3], "pm10": [20.5], "us_aqi": [42], **changes}
    return {"hourly": {k: v for k, v in hourly.items() if v != "absent"}}


def weather(**changes):
    hourly = {
        "time": [T],
        "temperature_2m": [31.5],
        "relative_humidity_2m": [63],
        "wind_speed_10m": [12.1],
        **changes,
    }
    return {"hourly": {k: v for k, v in hourly.items() if v != "absent"}}


CASES = [
    (AQI, aqi(), "ok", None),
    (AQI, aqi(us_aqi="absent"), "missing_columns", "missing required columns: us_aqi."),
    (AQI, aqi(us_aqi="absent", pm10="absent"), "missing_columns", "columns: pm10, us_aqi."),
    (AQI, aqi(time="absent"), "missing_columns", "columns: time."),
    (AQI, aqi(time=["not-a-timestamp"]), "invalid_timestamps", "invalid forecast timestamps"),
    (AQI, aqi(time=[None]), "invalid_timestamps", "invalid"),
    (AQI, aqi(time=None), "invalid_timestamps", "invalid"),
    (
        AQI,
        aqi(pm2_5=[None], pm10=[None], us_aqi=[None]),
        "no_metrics",
        "does not contain any non-null AQI metrics",
    ),
    (AQI, aqi(pm2_5=[None], pm10=None, us_aqi=[None]), "no_metrics", "non-null"),
    (AQI, aqi(pm2_5=[None], pm10=None), "ok", None),
    (AQI, {}, "missing_hourly", "does not contain an hourly section"),
    (AQI, {"hourly": {}}, "missing_hourly", "hourly section"),
    (AQI, {"hourly": None}, "missing_hourly", "hourly section"),
    (AQI, {"hourly": []}, "missing_hourly", "hourly section"),
    (AQI, aqi(time=[T, T]), "ragged_arrays", "different lengths"),
    (AQI, aqi(extra=[1, 2]), "ragged_arrays", "different lengths"),
    # lengths are looked at before names
    (AQI, aqi(us_aqi="absent", pm10=[]), "ragged_arrays", "different lengths"),
    (AQI, aqi(time=[], pm2_5=[], pm10=[], us_aqi=[]), "empty", "no hourly rows"),
    (AQI, aqi(time=5), "ragged_arrays", "different lengths"),
    (AQI, aqi(extra=["x"]), "ok", None),
    (AQI, aqi(pm2_5=["x"]), "invalid_readings", "that are no numbers"),
    (AQI, aqi(pm2_5=["12.5"], us_aqi=[None]), "ok", None),
    (AQI, aqi(us_aqi=[3e9]), "invalid_readings", "that are no numbers"),
    (AQI, aqi() | {"latitude": "north"}, "invalid_readings", "coordinates"),
    (AQI, aqi() | {"latitude": None, "longitude": 100.5}, "ok", None),
    (AQI, aqi(pm2_5=["x"], time=["soon"]), "invalid_timestamps", "timestamps"),
    (WEATHER, weather(wind_speed_10m=[True]), "invalid_readings", "Weather payload contains readings"),
    (WEATHER, weather(), "ok", None),
    (
        WEATHER,
        weather(relative_humidity_2m="absent"),
        "missing_columns",
        "missing required columns: relative_humidity_2m.",
    ),
    (WEATHER, weather(time=["not-a-timestamp"]), "invalid_timestamps", "invalid forecast timestamps"),
    (WEATHER, {}, "missing_hourly", "does not contain an hourly section"),
    # weather may be all null
    (
        WEATHER,
        weather(temperature_2m=[None], relative_humidity_2m=[None], wind_speed_10m=[None]),
        "ok",
        None,
    ),
]


def test_verdicts(spark):
    for feed in (AQI, WEATHER):
        cases = [c for c in CASES if c[0] is feed]
        docs = frame(
            spark, "id int, payload string", *[(i, json.dumps(c[1])) for i, c in enumerate(cases)]
        )
        got = {r["id"]: r for r in with_verdict(docs, feed).collect()}
        for i, (_, payload, verdict, detail) in enumerate(cases):
            assert got[i]["verdict"] == verdict, payload
            if detail is None:
                assert got[i]["detail"] is None
            else:
                assert detail in got[i]["detail"]


@pytest.mark.parametrize("text", ["not json", "[1, 2]", "", "null", None])
def test_what_is_not_an_object_is_unreadable(spark, text):
    docs = frame(spark, "payload string", (text,))
    assert with_verdict(docs, AQI).first()["verdict"] == "unreadable"


def test_split_keeps_every_document(spark):
    docs = frame(
        spark, "id int, payload string", *[(i, json.dumps(c[1])) for i, c in enumerate(CASES)]
    )
    good, bad = valid_documents(docs, AQI), quarantine(docs, AQI)
    assert good.columns == docs.columns
    assert good.count() + bad.count() == docs.count()
    assert bad.where("detail is null").count() == 0


def test_a_document_is_parsed_once(spark):
    docs = frame(spark, "id int, payload string", (1, json.dumps(aqi())))
    docs.write.mode("overwrite").parquet(spark.conf.get("spark.checkpoint.dir") + "/parse-once")
    stored = spark.read.parquet(spark.conf.get("spark.checkpoint.dir") + "/parse-once")
    plan = quarantine(stored, AQI)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
