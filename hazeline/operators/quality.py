"""Data-quality checks. A check passes when it finds no failing rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from hazeline.functions.clock import hour_floor
from hazeline.specs import AQI, FILE, HOUR, INGEST_TOKEN, WEATHER

# Columns each model must always fill, and must not repeat.
STAGED_NOT_NULL = (HOUR, INGEST_TOKEN, "source_system", FILE)
MART_NOT_NULL = (
    "record_key",
    HOUR,
    "last_ingested_at_utc",
    "temperature_c",
    "relative_humidity",
    "wind_speed_kph",
)
MART_UNIQUE = ("record_key", HOUR)

# Rows one generator step may put out when repeated hours are spelled out.
REPEAT_CHUNK = 100_000


class DataQualityError(RuntimeError):
    """At least one check failed."""


def not_null_failures(df: DataFrame, columns: Sequence[str], prefix: str) -> DataFrame:
    """Null counts of all ``columns`` in one pass."""
    return _counts(df, {f"{prefix}.{c}.not_null": F.col(c).isNull() for c in columns})


def accepted_values_failures(
    df: DataFrame, accepted: Mapping[str, Sequence[str]], prefix: str
) -> DataFrame:
    """Rows outside each column's accepted values, in one pass; nulls pass."""
    return _counts(
        df, {f"{prefix}.{c}.accepted_values": ~F.col(c).isin(*v) for c, v in accepted.items()}
    )


def unique_failures(
    df: DataFrame, columns: Sequence[str | Sequence[str]], prefix: str
) -> DataFrame:
    """Number of values that occur more than once, per column or group of columns; nulls are ignored.

    Values are compared in their own types, so instants an hour apart never read the same. Counting is by
    value with partial sums before the shuffle, so a value repeated in a third of all rows is one row
    per input partition.
    """
    groups = {"+".join(g): g for g in ((c,) if isinstance(c, str) else tuple(c) for c in columns)}
    counted = []
    for name, group in groups.items():
        known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in group])
        values = df.where(known).groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
        counted.append(values.where("n > 1").select(F.lit(name).alias("c")))
    repeated = reduce(DataFrame.unionByName, counted)
    return _counts(repeated, {f"{prefix}.{c}.unique": F.col("c") == c for c in groups})


def metric_out_of_range(aqi_max: int = 500) -> Column:
    """Negative particulates, or an index outside ``0..aqi_max``. Nulls pass."""
    return (
        (F.col("pm25") < 0)
        | (F.col("pm10") < 0)
        | ~F.col("us_aqi").between(0, aqi_max)
    )


def weather_out_of_range() -> Column:
    """Humidity outside 0..100, or negative wind. Nulls pass."""
    return ~F.col("relative_humidity").between(0, 100) | (F.col("wind_speed_kph") < 0)


def metric_range_violations(mart: DataFrame, aqi_max: int = 500) -> DataFrame:
    return mart.where(metric_out_of_range(aqi_max))


def weather_range_violations(mart: DataFrame) -> DataFrame:
    return mart.where(weather_out_of_range())


def hourly_gaps(df: DataFrame, hour: str = HOUR, keys: Sequence[str] = ()) -> DataFrame:
    """Neighbouring hours that are not exactly one hour boundary apart, per key.

    Rows are first reduced to distinct hours. The hour before each one is looked up within its
    date, where there are few; only the first hour of a date needs the last one of the date
    before, and those come from one row per date. So without keys no task sees more than the
    calendar, however many rows there are. An hour that occurs n times is reported n - 1 times
    against itself.
    """
    names = [*keys, hour]
    on_date = Window.partitionBy(*keys, "_day")
    dates = Window.partitionBy(*keys).orderBy("_day")
    hours = (
        df.where(F.col(hour).isNotNull())
        .groupBy(*names)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_day", F.col(hour).cast("date"))
        .withColumn("_before", F.lag(hour).over(on_date.orderBy(hour)))
        .withColumn("_last", F.max(hour).over(on_date))
    )
    later = hours.where(F.col("_before").isNotNull())
    first = hours.where(F.col("_before").isNull()).withColumn("_before", F.lag("_last").over(dates))
    jump = hour_floor(F.col(hour)) - hour_floor(F.col("_before"))
    found = (
        later.unionByName(first)
        .withColumn("_gap", F.coalesce(jump != F.lit(timedelta(hours=1)), F.lit(False)))
        .where(F.col("_gap") | (F.col("_n") > 1))
    )
    return _spelled_out(found, names, hour)


def _spelled_out(found: DataFrame, names: Sequence[str], hour: str) -> DataFrame:
    """One row per gap and per repeat. Repeats are put out in chunks that spread over tasks."""
    repeats, chunk, step = F.col("_n") - 1, F.lit(REPEAT_CHUNK), F.col("_chunk")
    chunks = F.floor(F.greatest(repeats - 1, F.lit(0)) / chunk)
    size = F.least(chunk, repeats - step * chunk).cast("int")
    none = F.array_repeat(F.col(hour), F.lit(0))
    gap = F.when((step == 0) & F.col("_gap"), F.array("_before")).otherwise(none)
    pairs = F.concat(gap, F.array_repeat(F.col(hour), size))
    return (
        found.select(
            *names, "_n", "_gap", "_before", F.explode(F.sequence(F.lit(0), chunks)).alias("_chunk")
        )
        .repartition(*names, "_chunk")
        .select(*names, F.explode(pairs).alias(f"previous_{hour}"))
    )


def staged_checks(staged: DataFrame, prefix: str, source_system: str) -> DataFrame:
    """Checks of one silver table, in a single pass over it."""
    conditions = {f"{prefix}.{c}.not_null": F.col(c).isNull() for c in STAGED_NOT_NULL}
    conditions[f"{prefix}.source_system.accepted_values"] = F.col("source_system") != source_system
    return _counts(staged, conditions)


def mart_checks(
    mart: DataFrame, prefix: str = "fct_aqi_hourly", keys: Sequence[str] = (), aqi_max: int = 500
) -> DataFrame:
    """Checks of the mart: one pass for row conditions, one grouped pass each for the rest.

    With keys, an hour must be unique, and hours without gaps, per key.
    """
    conditions = {f"{prefix}.{c}.not_null": F.col(c).isNull() for c in MART_NOT_NULL}
    conditions["valid_metric_ranges"] = metric_out_of_range(aqi_max)
    conditions["valid_weather_ranges"] = weather_out_of_range()
    gaps = hourly_gaps(mart.select(*keys, HOUR), HOUR, keys).agg(
        F.lit("no_missing_hourly_gaps").alias("check_name"),
        F.count(F.lit(1)).alias("failing_rows"),
    )
    unique = ["record_key", [*keys, HOUR]]
    return reduce(
        DataFrame.unionByName,
        [_counts(mart, conditions), unique_failures(mart, unique, prefix), gaps],
    )


def dq_report(
    staged_aqi: DataFrame,
    staged_weather: DataFrame,
    mart: DataFrame,
    keys: Sequence[str] = (),
    aqi_max: int = 500,
) -> DataFrame:
    """All checks: ``check_name, failing_rows, passed``."""
    return with_outcome(
        staged_checks(staged_aqi, "stg_aqi_hourly", AQI.source_system)
        .unionByName(staged_checks(staged_weather, "stg_weather_hourly", WEATHER.source_system))
        .unionByName(mart_checks(mart, keys=keys, aqi_max=aqi_max))
    )


def with_outcome(failures: DataFrame) -> DataFrame:
    return failures.withColumn("passed", F.col("failing_rows") == 0)


def require_passing(report: DataFrame) -> None:
    """Raise unless every check passed. The report has one row per check, so it is small."""
    failed = report.where(~F.col("passed")).orderBy("check_name").collect()
    if failed:
        listing = ", ".join(f"{r['check_name']} ({r['failing_rows']})" for r in failed)
        raise DataQualityError(f"failed checks: {listing}")


def _counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """``check_name, failing_rows``: one aggregation, turned from columns into rows."""
    names = [f"_c{i}" for i in range(len(conditions))]
    totals = df.agg(*[F.count_if(c).alias(n) for n, c in zip(names, conditions.values())])
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("check_name"), F.col(n).alias("failing_rows"))
            for n, name in zip(names, conditions)
        ]
    )
    return totals.select(F.inline(rows))
