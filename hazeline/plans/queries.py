"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.functions.clock import as_naive_utc, hours_crossed, ingest_instant
from hazeline.functions.numbers import whole
from hazeline.functions.paths import ingest_token, object_path, record_key
from hazeline.operators import quality, serving
from hazeline.operators.explode import explode_hourly
from hazeline.operators.validation import OK, with_verdict
from hazeline.operators.versions import latest_version, newest_first, version_history
from hazeline.plans.feeds import FILE_PREFIX, documents, feed, ragged_documents
from hazeline.plans.gold import gold_mart
from hazeline.plans.silver import silver, silver_from_landing
from hazeline.session import cut_lineage, scratch_path
from hazeline.sources.bronze import (
    land_documents,
    latest_landing,
    list_files,
    list_objects,
    parse_documents,
    read_document_tree,
    read_landing,
)
from hazeline.sources.tables import (
    MART,
    has_mart,
    load_hourly,
    read_stored,
    served_columns,
    write_model,
    write_table,
)
from hazeline.specs import AQI, DATE, FILE, HOUR, INGEST_TOKEN, METRIC_LABELS, WEATHER
from hazeline.streaming.mart import stream_mart, streamed_mart
from hazeline.streaming.silver import stream_silver

TIE_BREAK = ("event_id",)
BY_HOUR = (HOUR,)
BY_USER = ("user_id", HOUR)
# The AQI feed never goes above 490, so its range check is asked for less to have findings.
AQI_MAX = 300
NOW = datetime(2024, 1, 31, 0, 30)
WINDOW = (date(2024, 1, 10), date(2024, 1, 16))
# Dates before this one are stored without weather columns where drift is asked for.
WEATHER_SINCE = date(2024, 1, 16)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def staged(spark, sf_dir, dataset) -> DataFrame:
    return feed(events(spark, sf_dir), dataset)


def staged_pair(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Both feeds over one listing of the table."""
    source = events(spark, sf_dir)
    return feed(source, AQI), feed(source, WEATHER)


def mart(spark, sf_dir, keys=BY_HOUR) -> DataFrame:
    return gold_mart(*staged_pair(spark, sf_dir), keys, TIE_BREAK)


def naive(df: DataFrame, column: str) -> DataFrame:
    """A zoned column as zone-less UTC time."""
    return df.withColumn(column, as_naive_utc(F.col(column), "timestamp"))


def hourly(spark, sf_dir, keys=BY_HOUR) -> DataFrame:
    """The mart as the serving layer gets it, with zone-less ingest times."""
    return mart(spark, sf_dir, keys).drop("record_key")


# -- bronze -------------------------------------------------------------------------------------


def bronze_object_path(spark, sf_dir):
    path = object_path(F.col("ts"), AQI.name, FILE_PREFIX)
    return events(spark, sf_dir).select("event_id", path.alias("path"))


def landed(spark, sf_dir, label, *datasets, defects=False) -> str:
    """Land the documents of the feeds in a fresh folder and return it."""
    root, source = scratch_path(spark, label), events(spark, sf_dir)
    docs = reduce(DataFrame.unionByName, [documents(source, d, defects) for d in datasets])
    land_documents(docs, root)
    return root


def bronze_scan(spark, sf_dir):
    root = landed(spark, sf_dir, "scan", AQI, WEATHER)
    parts = [
        parse_documents(read_landing(spark, root, d), d).select(
            "dataset",
            "ingest_date",
            F.size("hourly.time").alias("hours"),
            F.col("hourly")[d.reading_fields[0]][0].alias("first_value"),
            FILE,
        )
        for d in (AQI, WEATHER)
    ]
    return parts[0].unionByName(parts[1])


def bronze_tree_scan(spark, sf_dir):
    """The documents as JSON text files below ``ingest_date=`` folders, read by the JSON reader."""
    root, source = scratch_path(spark, "tree"), events(spark, sf_dir)
    parts = []
    for d in (AQI, WEATHER):
        lines = documents(source, d).select("payload", "ingest_date")
        by_date = lines.hint("rebalance", F.col("ingest_date")).write.partitionBy("ingest_date")
        by_date.format("text").option("compression", "none").save(f"{root}/{d.name}")
        docs = read_document_tree(spark, f"{root}/{d.name}", d, False, "*.txt")
        parts.append(
            docs.select(
                F.lit(d.name).alias("dataset"),
                "ingest_date",
                "latitude",
                "longitude",
                F.col("hourly.time")[0].alias("first_time"),
                F.col("hourly")[d.reading_fields[2]][3].alias("last_value"),
            )
        )
    return parts[0].unionByName(parts[1])


def bronze_file_listing(spark, sf_dir):
    """Which feeds and ingest dates have files."""
    files = list_files(spark, landed(spark, sf_dir, "files", AQI, WEATHER))
    folder = r"dataset=([^/]+)/ingest_date=([^/]+)/[^/]+\.parquet$"
    return (
        files.select(
            F.regexp_extract("path", folder, 1).alias("dataset"),
            F.regexp_extract("path", folder, 2).alias("ingest_date"),
        )
        .where(F.col("dataset") != "")
        .distinct()
    )


def bronze_listing(spark, sf_dir):
    root = landed(spark, sf_dir, "listing", AQI, WEATHER)
    return list_objects(read_landing(spark, root), "raw/weather/")


def bronze_roundtrip(spark, sf_dir):
    root = landed(spark, sf_dir, "roundtrip", WEATHER, defects=True)
    first_time = F.get_json_object("payload", "$.hourly.time[0]").alias("first_time")
    return latest_landing(read_landing(spark, root)).select(
        FILE, "dataset", "ingest_date", "landed_at_utc", first_time
    )


# -- silver -------------------------------------------------------------------------------------


def payload_explode(spark, sf_dir, dataset):
    docs = documents(events(spark, sf_dir), dataset)
    return explode_hourly(parse_documents(docs, dataset), dataset, ("event_id",))


def payload_explode_ragged(spark, sf_dir):
    return explode_hourly(ragged_documents(events(spark, sf_dir)), AQI, ("event_id",))


def silver_rows(spark, sf_dir, dataset):
    docs = documents(events(spark, sf_dir), dataset)
    return silver(parse_documents(docs, dataset), dataset, ("event_id",))


def ingest_time_parse(spark, sf_dir):
    token = ingest_token(F.col(FILE))
    return staged(spark, sf_dir, AQI).select(
        "event_id", FILE, token.alias(INGEST_TOKEN), ingest_instant(token).alias("ingested_at")
    )


def cast_round_int(spark, sf_dir):
    half = F.floor("value") + 0.5
    return events(spark, sf_dir).select(
        "event_id", "value", whole(F.col("value")).alias("nearest"), whole(half).alias("nearest_tie")
    )


def datediff_hour(spark, sf_dir):
    later = F.col("ts") + F.make_dt_interval(mins=F.floor("value").cast("int"))
    return events(spark, sf_dir).select("event_id", hours_crossed(F.col("ts"), later).alias("hours"))


def stream_silver_query(spark, sf_dir):
    root = landed(spark, sf_dir, "stream-in", AQI, defects=True)
    target = scratch_path(spark, "stream-out")
    run = stream_silver(spark, root, target, scratch_path(spark, "stream-state"), AQI)
    run.awaitTermination()
    return spark.read.parquet(target).drop("ingest_date", "landed_at_utc")


def landed_again(source: DataFrame, dataset) -> DataFrame:
    """Every third document once more, two hours later: other hours, other readings, other defects."""
    later = F.lit(timedelta(hours=2))
    third = source.where(F.col("event_id") % 3 == 0)
    changed = third.select(
        "event_id",
        "event_type",
        (F.col("ts") + later).alias("ts"),
        (F.col("user_id") + 3).alias("user_id"),
        (F.col("value") + 10).alias("value"),
    )
    first = F.col("landed_at_utc") - later
    docs = documents(changed, dataset, defects=True)
    docs = docs.withColumn(FILE, object_path(first, dataset.name, FILE_PREFIX))
    return docs.withColumn("ingest_date", first.cast("date"))


def stream_to_mart(spark, sf_dir):
    """The mart a stream keeps over two landings, the second of which replaces documents of the first."""
    root, source = scratch_path(spark, "mart-in"), events(spark, sf_dir)
    house, state = scratch_path(spark, "mart-out"), scratch_path(spark, "mart-state")
    for docs in (partial(documents, defects=True), landed_again):
        land_documents(docs(source, AQI).unionByName(docs(source, WEATHER)), root)
        stream_mart(spark, root, house, state).awaitTermination()
    return streamed_mart(spark, house)


# -- versions and gold --------------------------------------------------------------------------


def record_key_query(spark, sf_dir):
    key = record_key(F.col(HOUR), F.col(INGEST_TOKEN))
    return staged(spark, sf_dir, AQI).select("event_id", key.alias("record_key"))


def history(spark, sf_dir, keys):
    ranked = version_history(staged(spark, sf_dir, AQI), keys, newest_first(TIE_BREAK))
    return ranked.select(HOUR, "user_id", "event_id", INGEST_TOKEN, "us_aqi", "version_rank")


def latest(spark, sf_dir, dataset, keys):
    return latest_version(staged(spark, sf_dir, dataset), keys, newest_first(TIE_BREAK))


def latest_shipment_version(spark, sf_dir):
    newest = [F.col(c).desc_nulls_last() for c in ("l_shipdate", "l_orderkey", "l_linenumber")]
    return latest_version(table(spark, sf_dir, "lineitem"), ["l_partkey"], newest)


def bronze_to_gold(spark, sf_dir):
    source = events(spark, sf_dir)

    def side(dataset):
        docs = documents(source, dataset, defects=True)
        return silver_from_landing(docs, dataset, ("event_id",))

    return gold_mart(side(AQI), side(WEATHER), BY_HOUR, TIE_BREAK)


def materialize_mart(spark, sf_dir):
    return write_model(mart(spark, sf_dir), scratch_path(spark, "mart"), (DATE,))


def catalog_mart(spark, sf_dir):
    """The mart as a partitioned table, found in the catalog and read by its name.

    The table has a name of its own; a mart that the catalog holds already stays as it is.
    """
    name = f"{MART}_query"
    write_table(mart(spark, sf_dir), name, path=scratch_path(spark, "catalog"))
    if not has_mart(spark, name):
        raise RuntimeError(f"{name} is not in the catalog")
    return spark.table(name)


def mart_scan_mixed(spark, sf_dir):
    """A stored mart whose older dates have no weather columns, in one read."""
    gold, path = mart(spark, sf_dir), scratch_path(spark, "mixed")
    older = F.col(DATE) < F.lit(WEATHER_SINCE)
    write_model(gold.where(older).drop(*WEATHER.metric_columns), path)
    gold.where(~older).write.mode("append").partitionBy(DATE).parquet(path)
    return naive(load_hourly(read_stored(spark, path)), "last_ingested_at_utc")


def stored_window(spark, sf_dir):
    """A window of dates from the stored mart; the other dates' folders are not read."""
    stored = write_model(mart(spark, sf_dir), scratch_path(spark, "window"))
    return naive(serving.date_window(served_columns(stored), *WINDOW), "last_ingested_at_utc")


# -- checks -------------------------------------------------------------------------------------


def dq_not_null(spark, sf_dir):
    aqi, weather = staged_pair(spark, sf_dir)
    stg, gold = quality.STAGED_NOT_NULL, quality.MART_NOT_NULL
    return (
        quality.not_null_failures(aqi, stg, "stg_aqi_hourly")
        .unionByName(quality.not_null_failures(weather, stg, "stg_weather_hourly"))
        .unionByName(
            quality.not_null_failures(
                gold_mart(aqi, weather, BY_HOUR, TIE_BREAK), gold, "fct_aqi_hourly"
            )
        )
    )


def dq_unique(spark, sf_dir):
    aqi, weather = staged_pair(spark, sf_dir)
    gold = gold_mart(aqi, weather, BY_HOUR, TIE_BREAK)
    return quality.unique_failures(gold, quality.MART_UNIQUE, "fct_aqi_hourly").unionByName(
        quality.unique_failures(aqi, [HOUR, "user_id", FILE], "stg_aqi_hourly")
    )


def dq_accepted_values(spark, sf_dir):
    aqi, weather = staged_pair(spark, sf_dir)
    checks = (
        (aqi, {"source_system": [AQI.source_system]}, "stg_aqi_hourly"),
        (weather, {"source_system": [WEATHER.source_system]}, "stg_weather_hourly"),
        (events(spark, sf_dir), {"event_type": ["click", "view", "purchase", "signup"]}, "events"),
    )
    parts = [quality.accepted_values_failures(*c) for c in checks]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def dq_metric_range(spark, sf_dir):
    return quality.metric_range_violations(mart(spark, sf_dir), AQI_MAX)


def dq_weather_range(spark, sf_dir):
    return quality.weather_range_violations(mart(spark, sf_dir))


def feed_hours(spark, sf_dir, *kept):
    return staged(spark, sf_dir, AQI).select(*kept, HOUR)


def dq_hourly_gaps(spark, sf_dir):
    return quality.hourly_gaps(feed_hours(spark, sf_dir).distinct())


def dq_hourly_gaps_repeats(spark, sf_dir):
    return quality.hourly_gaps(feed_hours(spark, sf_dir))


def dq_hourly_gaps_by_user(spark, sf_dir):
    return quality.hourly_gaps(feed_hours(spark, sf_dir, "user_id"), keys=["user_id"])


def dq_report(spark, sf_dir):
    # checked as stored, like in the build, so that it is computed once for all checks
    aqi, weather = staged_pair(spark, sf_dir)
    gold = cut_lineage(gold_mart(aqi, weather, BY_HOUR, TIE_BREAK), "mart")
    return quality.dq_report(aqi, weather, gold, aqi_max=AQI_MAX)


def verdicts(spark, sf_dir):
    source = events(spark, sf_dir)
    parts = [
        with_verdict(documents(source, d, defects=True), d).select(
            "dataset", "event_id", "verdict", "detail"
        )
        for d in (AQI, WEATHER)
    ]
    return parts[0].unionByName(parts[1])


def payload_quarantine_counts(spark, sf_dir):
    bad = verdicts(spark, sf_dir).where(F.col("verdict") != OK)
    return bad.groupBy("dataset", "verdict").agg(F.count(F.lit(1)).alias("documents"))


# -- serving ------------------------------------------------------------------------------------


def mart_scan(spark, sf_dir):
    return naive(load_hourly(mart(spark, sf_dir)), "last_ingested_at_utc")


def mart_scan_backfill(spark, sf_dir):
    older = mart(spark, sf_dir).drop(*WEATHER.metric_columns)
    return naive(load_hourly(older), "last_ingested_at_utc")


def serve(function, spark, sf_dir, **options):
    return function(hourly(spark, sf_dir), **options)


def daily_summary_by_user(spark, sf_dir):
    return serving.daily_summary(hourly(spark, sf_dir, BY_USER), ["user_id"])


def aqi_band_query(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", F.col("value").alias("us_aqi"))
    return serving.with_band(rows)


def freshness(spark, sf_dir, key):
    return serving.freshness(events(spark, sf_dir), [key], "ts", NOW)


def headline_window(spark, sf_dir):
    return serving.headline_cards(serving.date_window(hourly(spark, sf_dir), *WINDOW))


QUERIES: dict[str, Query] = {
    "bronze_object_path": bronze_object_path,
    "bronze_scan": bronze_scan,
    "bronze_tree_scan": bronze_tree_scan,
    "bronze_listing": bronze_listing,
    "bronze_file_listing": bronze_file_listing,
    "bronze_roundtrip": bronze_roundtrip,
    "payload_verdicts": verdicts,
    "payload_quarantine_counts": payload_quarantine_counts,
    "payload_explode_aqi": partial(payload_explode, dataset=AQI),
    "payload_explode_weather": partial(payload_explode, dataset=WEATHER),
    "payload_explode_ragged": payload_explode_ragged,
    "silver_aqi": partial(silver_rows, dataset=AQI),
    "silver_weather": partial(silver_rows, dataset=WEATHER),
    "stream_silver": stream_silver_query,
    "stream_to_mart": stream_to_mart,
    "ingest_time_parse": ingest_time_parse,
    "cast_round_int": cast_round_int,
    "datediff_hour": datediff_hour,
    "record_key": record_key_query,
    "version_history": partial(history, keys=BY_HOUR),
    "version_history_by_user": partial(history, keys=BY_USER),
    "latest_version_aqi": partial(latest, dataset=AQI, keys=BY_HOUR),
    "latest_version_weather": partial(latest, dataset=WEATHER, keys=BY_HOUR),
    "latest_version_by_user": partial(latest, dataset=AQI, keys=BY_USER),
    "latest_shipment_version": latest_shipment_version,
    "gold_mart": mart,
    "gold_mart_by_user": partial(mart, keys=BY_USER),
    "bronze_to_gold": bronze_to_gold,
    "materialize_mart": materialize_mart,
    "catalog_mart": catalog_mart,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_accepted_values": dq_accepted_values,
    "dq_metric_range": dq_metric_range,
    "dq_weather_range": dq_weather_range,
    "dq_hourly_gaps": dq_hourly_gaps,
    "dq_hourly_gaps_repeats": dq_hourly_gaps_repeats,
    "dq_hourly_gaps_by_user": dq_hourly_gaps_by_user,
    "dq_report": dq_report,
    "mart_scan": mart_scan,
    "mart_scan_backfill": mart_scan_backfill,
    "mart_scan_mixed": mart_scan_mixed,
    "stored_window": stored_window,
    "date_window": partial(serve, serving.date_window, start=WINDOW[0], end=WINDOW[1]),
    "single_date": partial(serve, serving.single_date, day=WINDOW[0]),
    "daily_summary": partial(serve, serving.daily_summary),
    "daily_summary_by_user": daily_summary_by_user,
    "window_kpis": partial(serve, serving.window_kpis),
    "peak_hour": partial(serve, serving.peak_hour),
    "peak_hour_by_date": partial(serve, serving.peak_hour, keys=[DATE]),
    "current_hour": partial(serve, serving.current_hour),
    "current_delta": partial(serve, serving.current_delta),
    "metric_options": partial(serve, serving.metric_options),
    "melt_metrics": partial(serve, serving.melt_metrics, options=METRIC_LABELS),
    "melt_default_metric": partial(serve, serving.melt_metrics),
    "aqi_band": aqi_band_query,
    "band_counts": partial(serve, serving.band_counts),
    "freshness": partial(freshness, key="event_type"),
    "freshness_by_user": partial(freshness, key="user_id"),
    "map_points": partial(serve, serving.map_points),
    "status_rows": partial(serve, serving.status_rows),
    "headline_cards": partial(serve, serving.headline_cards),
    "headline_cards_window": headline_window,
    "display_table": partial(serve, serving.display_table),
}
