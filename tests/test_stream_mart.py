"""The mart kept by a stream against the mart of a batch over the newest landings."""

from __future__ import annotations

import json
from datetime import date, datetime

from pyspark.sql import functions as F

from hazeline.plans.gold import gold_mart
from hazeline.plans.silver import silver_from_landing
from hazeline.sources.bronze import LANDING_SCHEMA, land_documents, latest_landing, read_landing
from hazeline.sources.tables import MART
from hazeline.specs import AQI, DATE, HOUR, MART_COLUMNS, WEATHER
from hazeline.streaming.mart import refresh_mart, stream_mart, streamed_mart
from tests.conftest import plan_of, rows


def payload(feed, start, hours, value):
    times = [f"{start}T{h:02d}:00" for h in range(hours)]
    hourly = {"time": times} | {f: [value + h for h in range(hours)] for f in feed.reading_fields}
    return json.dumps({"latitude": 13.75, "longitude": 100.5, "hourly": hourly})


def landing(feed, token, text, landed, file=True):
    name = f"raw/{feed.name}/ingest_date=2026-03-24/{feed.file_prefix}_{token}.json" if file else None
    return (name, text, landed, feed.name, date(2026, 3, 24))


def land(spark, root, *docs):
    land_documents(spark.createDataFrame(list(docs), LANDING_SCHEMA), root)


def batch_mart(spark, root):
    sides = [silver_from_landing(latest_landing(read_landing(spark, root, f)), f) for f in (AQI, WEATHER)]
    return gold_mart(*sides)


EARLY, LATE = "20260324T010000Z", "20260324T020000Z"
NOON, ONE, TWO = (datetime(2026, 3, 24, h) for h in (12, 13, 14))
FIRST = (
    landing(AQI, EARLY, payload(AQI, "2026-03-24", 5, 10), NOON),
    landing(AQI, LATE, payload(AQI, "2026-03-25", 3, 50), NOON),
    landing(AQI, "20260324T030000Z", "no JSON", NOON),
    landing(WEATHER, EARLY, payload(WEATHER, "2026-03-24", 4, 20), NOON),
)
AGAIN = (
    # hours 2 to 4 are left out now, the second document is broken, the third is mended, weather changes
    landing(AQI, EARLY, payload(AQI, "2026-03-24", 2, 11), ONE),
    landing(AQI, LATE, "{}", ONE),
    landing(AQI, "20260324T030000Z", payload(AQI, "2026-03-26", 2, 70), ONE),
    landing(WEATHER, EARLY, payload(WEATHER, "2026-03-24", 1, 30), ONE),
)


def test_landing_again_gives_the_batch_mart(spark, tmp_path):
    root, house, state = (str(tmp_path / n) for n in ("landing", "house", "state"))

    def run():
        stream_mart(spark, root, house, state).awaitTermination()
        return rows(streamed_mart(spark, house))

    land(spark, root, *FIRST)
    first = run()
    assert first == rows(batch_mart(spark, root)) and len(first) == 8
    land(spark, root, *AGAIN)
    second = run()
    assert second == rows(batch_mart(spark, root)) and len(second) == 4
    assert {r[DATE] for r in streamed_mart(spark, house).collect()} == {date(2026, 3, 24), date(2026, 3, 26)}
    # landed late but older than what is there: nothing changes
    land(spark, root, landing(AQI, EARLY, payload(AQI, "2026-03-27", 4, 1), datetime(2026, 3, 24, 11)))
    assert run() == second == rows(batch_mart(spark, root))


def test_a_batch_may_be_run_again(spark, tmp_path):
    root, house = str(tmp_path / "landing"), str(tmp_path / "house")
    for number, docs in enumerate((FIRST, AGAIN)):
        for _ in range(2):
            refresh_mart(spark, spark.createDataFrame(list(docs), LANDING_SCHEMA), number, house)
        land(spark, root, *docs)
        assert rows(streamed_mart(spark, house)) == rows(batch_mart(spark, root))


def test_only_touched_dates_are_rewritten(spark, tmp_path):
    house = str(tmp_path / "house")

    def files():
        stored = spark.read.parquet(f"{house}/{MART}")
        named = stored.select(F.col(DATE), F.col("_metadata.file_path")).distinct().collect()
        return {(r[0], r[1]) for r in named}

    refresh_mart(spark, spark.createDataFrame(list(FIRST), LANDING_SCHEMA), 0, house)
    before = files()
    change = landing(AQI, LATE, payload(AQI, "2026-03-25", 1, 90), TWO)
    refresh_mart(spark, spark.createDataFrame([change], LANDING_SCHEMA), 1, house)
    assert {d for d, _ in before ^ files()} == {date(2026, 3, 25)}
    plan = plan_of(streamed_mart(spark, house).where(F.col(DATE) == date(2026, 3, 25)))
    assert f"PartitionFilters: [isnotnull({DATE}" in plan


def test_ties_repeats_missing_paths_and_empty_batches(spark, tmp_path):
    root, house = str(tmp_path / "landing"), str(tmp_path / "house")
    one = landing(AQI, EARLY, payload(AQI, "2026-03-24", 2, 10), NOON)
    other = landing(AQI, EARLY, payload(AQI, "2026-03-24", 3, 30), NOON)
    batches = ((), (one, one), (other,), (landing(AQI, LATE, None, None), landing(WEATHER, LATE, "[]", NOON)))
    for number, docs in enumerate(batches):
        refresh_mart(spark, spark.createDataFrame(list(docs), LANDING_SCHEMA), number, house)
        land(spark, root, *docs)
        got = streamed_mart(spark, house)
        assert got.columns == list(MART_COLUMNS)
        assert rows(got) == rows(batch_mart(spark, root))
    nameless = landing(AQI, EARLY, payload(AQI, "2026-03-28", 2, 10), NOON, file=False)
    refresh_mart(spark, spark.createDataFrame([nameless], LANDING_SCHEMA), 9, house)
    assert streamed_mart(spark, house).where(F.col(HOUR) >= "2026-03-28").count() == 2


def test_rows_and_marks_have_a_folder_per_month(spark, tmp_path):
    house = str(tmp_path / "house")
    days = [date(2026, 3, d) for d in range(2, 20)]
    docs = [landing(AQI, f"{d:%Y%m%d}T010000Z", payload(AQI, str(d), 2, d.day), NOON) for d in days]
    refresh_mart(spark, spark.createDataFrame(docs, LANDING_SCHEMA), 0, house)
    again = landing(AQI, "20260305T010000Z", payload(AQI, "2026-03-05", 1, 90), ONE)
    refresh_mart(spark, spark.createDataFrame([again], LANDING_SCHEMA), 1, house)
    for name in (f"rows_{AQI.name}", "marks"):
        assert len({f.parent for f in (tmp_path / "house" / name).rglob("*.parquet")}) == 2  # one per batch
    got = rows(streamed_mart(spark, house).groupBy(DATE).count())
    assert got == [(d, 1 if d.day == 5 else 2) for d in days]


def test_many_dates_are_written_by_several_tasks(spark, tmp_path):
    root, house = str(tmp_path / "landing"), str(tmp_path / "house")
    days = [date(2026, m, d) for m in (1, 3, 5) for d in range(1, 25)]
    docs = [landing(AQI, f"{d:%Y%m%d}T010000Z", payload(AQI, str(d), 2, d.day), NOON) for d in days]
    land(spark, root, *docs)
    refresh_mart(spark, spark.createDataFrame(docs, LANDING_SCHEMA), 0, house)
    got = rows(streamed_mart(spark, house))
    assert got == rows(batch_mart(spark, root)) and len(got) == 2 * len(days)
