"""The same queries as plain SQL over the same tables, for the side-by-side check."""

from __future__ import annotations

from hazeline.specs import AQI, METRIC_LABELS, WEATHER, Dataset

# fixed values: written out, not taken from the code they check
FILE_PREFIX = "feed_raw"
HOURS = 4
LATITUDE, LONGITUDE = 13.75, 100.5
AQI_MAX = 300
NOW = "2024-01-31 00:30:00"
STALE_AFTER_SECONDS = 7200
WINDOW = ("2024-01-10", "2024-01-16")
# upper bound, label, color, advisory; the last two rows are above all bounds and no value
BANDS = (
    (50, "Good", "#2E8540", "Air quality is considered satisfactory."),
    (100, "Moderate", "#D4A017", "Acceptable for most people, with minor risk for sensitive groups."),
    (
        150,
        "Unhealthy for Sensitive Groups",
        "#E67E22",
        "Sensitive groups should limit prolonged outdoor exertion.",
    ),
    (200, "Unhealthy", "#C0392B", "Everyone may begin to experience health effects."),
    (
        300,
        "Very Unhealthy",
        "#7D3C98",
        "Health alert conditions; outdoor activity should be reduced.",
    ),
    (
        "above",
        "Hazardous",
        "#6E2C00",
        "Emergency conditions; avoid outdoor activity where possible.",
    ),
    ("none", "Unknown", "#5C6770", "AQI data is not available for this selection."),
)

# SQL for a document field, given the event value.
SCALES = {
    "pm2_5": "({v})",
    "pm10": "({v}) * 1.5",
    "us_aqi": "({v})",
    "temperature_2m": "({v}) / 10",
    "relative_humidity_2m": "({v}) / 2",
    "wind_speed_10m": "({v}) / 20",
}


# fixed values: written out, so that a type lost by the feeds shows
TYPES = {AQI.name: "'click', 'view', 'error'", WEATHER.name: "'purchase', 'signup'"}


def _types(d: Dataset) -> str:
    return TYPES[d.name]


def _stamp(ts: str) -> str:
    return f"strftime({ts}, '%Y%m%dT%H%M%SZ')"


def _path(d: Dataset, ts: str = "ts") -> str:
    return (
        f"'raw/{d.name}/ingest_date=' || strftime({ts}, '%Y-%m-%d') || '/{FILE_PREFIX}_' "
        f"|| {_stamp(ts)} || '.json'"
    )


def _typed(d: Dataset, source: dict[str, str]) -> str:
    return ", ".join(
        f"cast({source[r.field]} as {'integer' if r.type == 'int' else 'double'}) as {r.column}"
        for r in d.readings
    )


def _feed(d: Dataset) -> str:
    values = {f: SCALES[f].format(v="value") for f in d.reading_fields}
    return f"""
    select date_trunc('hour', ts) as forecast_timestamp_local,
           cast(ts as date) as forecast_date_local,
           {_typed(d, values)},
           {_stamp('ts')} as ingest_time_utc,
           '{d.source_system}' as source_system,
           cast({LATITUDE} as double) as latitude, cast({LONGITUDE} as double) as longitude,
           {_path(d)} as raw_file_name, event_id, user_id
    from events where event_type in ({_types(d)})"""


FEEDS = f"aqi_feed as ({_feed(AQI)}), weather_feed as ({_feed(WEATHER)})"


def _newest(source: str, keys: str) -> str:
    return f"""
    select * exclude (place) from (
        select *, row_number() over (
            partition by {keys}
            order by strptime(ingest_time_utc, '%Y%m%dT%H%M%SZ') desc, raw_file_name desc, event_id desc
        ) as place from {source}) where place = 1"""


def _mart(aqi: str, weather: str, keys: tuple[str, ...] = ("forecast_timestamp_local",)) -> str:
    names = ", ".join(keys)
    extra = [k for k in keys if k != "forecast_timestamp_local"]
    same = " and ".join(f"a.{k} = w.{k}" for k in keys)
    key_parts = " || '|' || ".join(
        f"cast(a.{c} as varchar)" for c in ("forecast_timestamp_local", "ingest_time_utc", *extra)
    )
    return f"""
    select md5({key_parts}) as record_key, a.forecast_timestamp_local, a.forecast_date_local,
           a.pm25, a.pm10, a.us_aqi, w.temperature_c, w.relative_humidity, w.wind_speed_kph,
           strptime(a.ingest_time_utc, '%Y%m%dT%H%M%SZ') as last_ingested_at_utc,
           a.source_system, a.latitude, a.longitude {''.join(f', a.{k}' for k in extra)}
    from ({_newest(aqi, names)}) a left join ({_newest(weather, names)}) w on {same}"""


BY_USER = ("user_id", "forecast_timestamp_local")
WITH_MART = f"with {FEEDS}, mart as ({_mart('aqi_feed', 'weather_feed')})"
WITH_USER_MART = f"with {FEEDS}, mart as ({_mart('aqi_feed', 'weather_feed', BY_USER)})"
WITH_FEEDS = f"with {FEEDS}"
HOURLY = "* exclude (record_key)"


def _mean(column: str) -> str:
    return f"sum(cast({column} as decimal(18,6))) / count({column})"


def _rounded(column: str) -> str:
    return f"round_even({_mean(column)}, 1)"


def _daily(keys: str = "") -> str:
    return f"""
    select {keys} forecast_date_local, {_rounded('us_aqi')} as avg_aqi, max(us_aqi) as max_aqi,
           {_rounded('pm25')} as avg_pm25, {_rounded('pm10')} as avg_pm10,
           {_rounded('temperature_c')} as avg_temperature_c,
           {_rounded('relative_humidity')} as avg_relative_humidity,
           {_rounded('wind_speed_kph')} as avg_wind_speed_kph
    from mart group by {keys} forecast_date_local"""


def _band(value: str, part: str) -> str:
    place = ("upper", "label", "color", "advisory").index(part)
    text = {band[0]: f"'{band[place]}'" for band in BANDS}
    above, none = text.pop("above"), text.pop("none")
    arms = " ".join(f"when {value} <= {upper} then {shown}" for upper, shown in text.items())
    return (
        f"case when {value} is null or isnan(cast({value} as double)) then {none} "
        f"{arms} else {above} end"
    )


# -- documents ------------------------------------------------------------------------------------


def _documents(d: Dataset, where: str = "true", table: str = "events", named: str = "ts") -> str:
    """Hourly rows of the intact documents; ``named`` is the time in the file name."""
    steps = "[" + ", ".join(str(i) for i in range(HOURS)) + "]"
    lists = ", ".join(
        f"list_transform({steps}, lambda i: {SCALES[f].format(v='value + i')})"
        for f in d.reading_fields
    )
    times = (
        f"list_transform({steps}, lambda i: "
        "strftime(date_trunc('hour', ts) + to_hours(i), '%Y-%m-%dT%H:%M'))"
    )
    source = {f: f"element{n}" for n, f in enumerate(d.reading_fields, start=2)}
    return f"""
    select cast(element1 as timestamp) as forecast_timestamp_local, {_typed(d, source)},
           cast({LATITUDE} as double) as latitude, cast({LONGITUDE} as double) as longitude,
           raw_file_name, event_id
    from (select {_path(d, named)} as raw_file_name, event_id,
                 unnest(list_zip({times}, {lists}), recursive := true)
          from {table} where event_type in ({_types(d)}) and {where})"""


def _silver(d: Dataset, where: str = "true", table: str = "events", named: str = "ts") -> str:
    return f"""
    select forecast_timestamp_local, cast(forecast_timestamp_local as date) as forecast_date_local,
           {', '.join(d.metric_columns)},
           split_part(replace(raw_file_name, '.json', ''), '_raw_', 2) as ingest_time_utc,
           '{d.source_system}' as source_system, latitude, longitude, raw_file_name, event_id
    from ({_documents(d, where, table, named)})"""


def _verdicts(d: Dataset) -> str:
    last = d.reading_fields[-1]
    title = d.title
    nulls = (
        ("'no_metrics'", f"'{title} does not contain any non-null AQI metrics.'")
        if d.needs_a_value
        else ("'ok'", "null")
    )
    outcomes = {
        0: ("'missing_hourly'", f"'{title} does not contain an hourly section.'"),
        1: ("'missing_columns'", f"'{title} is missing required columns: {last}.'"),
        2: ("'ragged_arrays'", f"'{title} has hourly arrays of different lengths.'"),
        3: ("'invalid_timestamps'", f"'{title} contains invalid forecast timestamps.'"),
        4: nulls,
        5: ("'empty'", f"'{title} has no hourly rows.'"),
    }
    verdict = " ".join(f"when {k} then {v}" for k, (v, _) in outcomes.items())
    detail = " ".join(f"when {k} then {t}" for k, (_, t) in outcomes.items())
    return f"""
    select '{d.name}' as dataset, event_id,
           case user_id % 10 {verdict} else 'ok' end as verdict,
           case user_id % 10 {detail} else null end as detail
    from events where event_type in ({_types(d)})"""


VERDICTS = f"{_verdicts(AQI)} union all {_verdicts(WEATHER)}"

# Which documents with planted defects come through. All-null weather readings are allowed, so
# those documents give rows of nulls.
AQI_OK = "user_id % 10 > 5"
WEATHER_OK = "(user_id % 10 > 5 or user_id % 10 = 4)"


def _nulled_weather(source: str = "events", named: str = "ts") -> str:
    silver = _silver(WEATHER, WEATHER_OK, source, named)
    nulled = ", ".join(
        f"case when e.user_id % 10 <> 4 then s.{c} end as {c}" for c in WEATHER.metric_columns
    )
    return f"""
    select s.* replace ({nulled}) from ({silver}) s join {source} e on s.event_id = e.event_id"""


# Documents in two landings, every third once more with other contents; the last landing of a path counts.
# Feeds never share a path, and no two documents of one path land at the same moment.
LANDINGS = """
    landings as (
        select event_id, event_type, user_id, value, ts, ts as named from events
        union all
        select event_id, event_type, user_id + 3, value + 10, ts + to_hours(2), ts
        from events where event_id % 3 = 0),
    last_landings as (
        select * from landings
        qualify row_number() over (
            partition by event_type in ('purchase', 'signup'), date_trunc('second', named)
            order by ts desc) = 1)"""


def _scan(d: Dataset) -> str:
    first = SCALES[d.reading_fields[0]].format(v="value + 0")
    return f"""
    select '{d.name}' as dataset, cast(ts as date) as ingest_date, {HOURS} as hours,
           {first} as first_value, {_path(d)} as raw_file_name
    from events where event_type in ({_types(d)})"""


def _tree(d: Dataset) -> str:
    last = SCALES[d.reading_fields[2]].format(v="value + 3")
    return f"""
    select '{d.name}' as dataset, cast(ts as date) as ingest_date,
           cast({LATITUDE} as double) as latitude, cast({LONGITUDE} as double) as longitude,
           strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M') as first_time, {last} as last_value
    from events where event_type in ({_types(d)})"""


# -- checks ---------------------------------------------------------------------------------------

STAGED = ("forecast_timestamp_local", "ingest_time_utc", "source_system", "raw_file_name")
GOLD = (
    "record_key",
    "forecast_timestamp_local",
    "last_ingested_at_utc",
    "temperature_c",
    "relative_humidity",
    "wind_speed_kph",
)
METRIC_RANGE = f"pm25 < 0 or pm10 < 0 or us_aqi < 0 or us_aqi > {AQI_MAX}"
WEATHER_RANGE = "relative_humidity < 0 or relative_humidity > 100 or wind_speed_kph < 0"


def _count_where(name: str, source: str, condition: str) -> str:
    return (
        f"select '{name}' as check_name, count(*) filter (where {condition}) as failing_rows "
        f"from {source}"
    )


def _nulls(prefix: str, source: str, columns: tuple[str, ...]) -> list[str]:
    return [_count_where(f"{prefix}.{c}.not_null", source, f"{c} is null") for c in columns]


def _unique(prefix: str, source: str, column: str) -> str:
    repeated = (
        f"(select {column} from {source} where {column} is not null "
        f"group by {column} having count(*) > 1)"
    )
    return f"select '{prefix}.{column}.unique' as check_name, count(*) as failing_rows from {repeated}"


def _accepted(prefix: str, source: str, column: str, values: str) -> str:
    return _count_where(f"{prefix}.{column}.accepted_values", source, f"{column} not in ({values})")


def _gaps(source: str, keys: str = "") -> str:
    hour = "forecast_timestamp_local"
    partition = f"partition by {keys.rstrip(', ')}" if keys else ""
    return f"""
    select {keys} {hour}, previous_{hour} from (
        select {keys} {hour}, lag({hour}) over ({partition} order by {hour}) as previous_{hour}
        from {source})
    where previous_{hour} is not null and datediff('hour', previous_{hour}, {hour}) <> 1"""


HOURS_BY_USER = (
    "(select user_id, date_trunc('hour', ts) as forecast_timestamp_local from events "
    "where event_type in ('click', 'view', 'error'))"
)
FEED_HOURS = f"(select distinct forecast_timestamp_local from {HOURS_BY_USER})"

NOT_NULL = [
    *_nulls("stg_aqi_hourly", "aqi_feed", STAGED),
    *_nulls("stg_weather_hourly", "weather_feed", STAGED),
    *_nulls("fct_aqi_hourly", "mart", GOLD),
]
ACCEPTED = [
    _accepted("stg_aqi_hourly", "aqi_feed", "source_system", "'open-meteo'"),
    _accepted("stg_weather_hourly", "weather_feed", "source_system", "'open-meteo-weather'"),
]
MART_UNIQUE = [
    _unique("fct_aqi_hourly", "mart", "record_key"),
    _unique("fct_aqi_hourly", "mart", "forecast_timestamp_local"),
]
REPORT = [
    *NOT_NULL,
    *ACCEPTED,
    *MART_UNIQUE,
    _count_where("valid_metric_ranges", "mart", METRIC_RANGE),
    _count_where("valid_weather_ranges", "mart", WEATHER_RANGE),
    f"select 'no_missing_hourly_gaps' as check_name, count(*) as failing_rows from ({_gaps('mart')})",
]


def _union(parts: list[str]) -> str:
    return " union all ".join(parts)


# -- serving --------------------------------------------------------------------------------------

FIRST = "(select * from mart order by forecast_timestamp_local limit 1)"
PEAK = (
    "(select * from mart where us_aqi is not null "
    "order by us_aqi desc, forecast_timestamp_local limit 1)"
)
TWO = (
    "(select *, row_number() over (order by forecast_timestamp_local) as place from mart "
    "qualify place <= 2)"
)
DELTA = f"""
    select min(forecast_timestamp_local) as forecast_timestamp_local,
           max(case when place = 1 then us_aqi end) as us_aqi,
           max(case when place = 1 then us_aqi end)
             - coalesce(max(case when place = 2 then us_aqi end),
                        max(case when place = 1 then us_aqi end)) as aqi_delta
    from {TWO} having count(*) > 0"""


def _fact(label: str, value: str, source: str) -> str:
    return f"select '{label}' as label, {value} as value from {source}"


def _text(column: str, digits: int, unit: str) -> str:
    return f"format('{{:.{digits}f}}', {column}) || '{unit}'"


STATUS = _union(
    [
        _fact("Source system", "source_system", FIRST),
        _fact("Coordinates", f"{_text('latitude', 2, ', ')} || {_text('longitude', 2, '')}", FIRST),
        _fact("Peak forecast hour", "strftime(forecast_timestamp_local, '%Y-%m-%d %H:%M')", PEAK),
        _fact("Peak AQI band", _band("us_aqi", "label"), PEAK),
        _fact("Temperature", _text("temperature_c", 1, " C"), FIRST),
        _fact("Wind speed", _text("wind_speed_kph", 1, " km/h"), FIRST),
    ]
)


def _optional(column: str, digits: int, unit: str) -> str:
    return f"coalesce({_text(column, digits, unit)}, 'N/A')"


CARDS = _union(
    [
        _fact("Next forecast hour", "strftime(forecast_timestamp_local, '%Y-%m-%d %H:%M')", FIRST),
        _fact("Next forecast AQI", "cast(us_aqi as varchar)", FIRST),
        _fact("Current band", _band("us_aqi", "label"), FIRST),
        _fact("Current advisory", _band("us_aqi", "advisory"), FIRST),
        _fact("Peak AQI in window", "cast(us_aqi as varchar)", PEAK),
        _fact(
            "Average PM2.5",
            "format('{:.1f}', m)",
            f"(select {_mean('pm25')} as m from mart having count(*) > 0)",
        ),
        _fact("Temperature", _optional("temperature_c", 1, " C"), FIRST),
        _fact("Relative humidity", _optional("relative_humidity", 0, "%"), FIRST),
        _fact("Wind speed", _optional("wind_speed_kph", 1, " km/h"), FIRST),
        _fact(
            "Last ingestion (UTC)",
            "strftime(m, '%Y-%m-%d %H:%M')",
            "(select max(last_ingested_at_utc) as m from mart having count(*) > 0)",
        ),
        _fact("Change to the hour after", "format('{:+d}', aqi_delta)", f"({DELTA})"),
    ]
)

OPTIONS = _union(
    [
        f"select '{key}' as metric_key, '{label}' as label"
        + (f" from mart having count({key}) > 0" if key in WEATHER.metric_columns else "")
        for key, label in METRIC_LABELS.items()
    ]
)
LONG = _union(
    [
        f"select forecast_timestamp_local, cast({key} as double) as value, '{label}' as metric from mart"
        for key, label in METRIC_LABELS.items()
    ]
)


def _in_window(start, end) -> str:
    return f"forecast_date_local between date '{start}' and date '{end}'"


def _fresh(key: str) -> str:
    return f"""
    select {key}, max(ts) as last_ingested_at_utc,
           coalesce(timestamp '{NOW}' - max(ts) > to_seconds({STALE_AFTER_SECONDS}), true) as is_stale
    from events group by {key}"""


def _history(keys: str) -> str:
    return f"""{WITH_FEEDS}
    select forecast_timestamp_local, user_id, event_id, ingest_time_utc, us_aqi,
           row_number() over (
               partition by {keys}
               order by strptime(ingest_time_utc, '%Y%m%dT%H%M%SZ') desc, raw_file_name desc, event_id desc
           ) as version_rank
    from aqi_feed"""


ORACLE: dict[str, str] = {
    "bronze_object_path": f"select event_id, {_path(AQI)} as path from events",
    "bronze_scan": f"{_scan(AQI)} union all {_scan(WEATHER)}",
    "bronze_tree_scan": f"{_tree(AQI)} union all {_tree(WEATHER)}",
    "bronze_file_listing": _union(
        [
            f"select distinct '{d.name}' as dataset, strftime(ts, '%Y-%m-%d') as ingest_date "
            f"from events where event_type in ({_types(d)})"
            for d in (AQI, WEATHER)
        ]
    ),
    "bronze_listing": (
        f"select distinct {_path(WEATHER)} as raw_file_name from events "
        f"where event_type in ({_types(WEATHER)})"
    ),
    "bronze_roundtrip": f"""
        select {_path(WEATHER)} as raw_file_name, 'weather' as dataset, cast(ts as date) as ingest_date,
               ts as landed_at_utc,
               case user_id % 10 when 0 then null when 5 then null when 3 then 'not-a-timestamp'
                    else strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M') end as first_time
        from events where event_type in ({_types(WEATHER)})
        qualify row_number() over (partition by {_path(WEATHER)} order by ts desc) = 1""",
    "payload_verdicts": VERDICTS,
    "payload_quarantine_counts": f"""
        select dataset, verdict, count(*) as documents from ({VERDICTS})
        where verdict <> 'ok' group by dataset, verdict""",
    "payload_explode_aqi": _documents(AQI),
    "payload_explode_weather": _documents(WEATHER),
    "payload_explode_ragged": f"""
        select timestamp '2024-01-01 00:00' + to_hours(i) as forecast_timestamp_local,
               case i when 0 then value when 1 then value + 1 end as pm25,
               case when user_id % 2 = 0 then value end as pm10,
               cast(value * (i + 1) as integer) as us_aqi,
               cast({LATITUDE} as double) as latitude, cast({LONGITUDE} as double) as longitude,
               {_path(AQI)} as raw_file_name, event_id
        from events, (values (0), (1), (2)) as steps(i) where event_type in ({_types(AQI)})""",
    "silver_aqi": _silver(AQI),
    "silver_weather": _silver(WEATHER),
    "stream_silver": f"select * exclude (event_id) from ({_silver(AQI, AQI_OK)})",
    "stream_to_mart": f"""
        with {LANDINGS}, a as ({_silver(AQI, AQI_OK, 'last_landings', 'named')}),
        w as ({_nulled_weather('last_landings', 'named')}) {_mart('a', 'w')}""",
    "ingest_time_parse": f"""{WITH_FEEDS}
        select event_id, raw_file_name,
               split_part(replace(raw_file_name, '.json', ''), '_raw_', 2) as ingest_time_utc,
               strptime(ingest_time_utc, '%Y%m%dT%H%M%SZ') as ingested_at
        from aqi_feed""",
    "cast_round_int": """
        select event_id, value, cast(value as integer) as nearest,
               cast(floor(value) + 0.5 as integer) as nearest_tie
        from events""",
    "datediff_hour": """
        select event_id, datediff('hour', ts, ts + to_minutes(cast(floor(value) as integer))) as hours
        from events""",
    "record_key": f"""{WITH_FEEDS}
        select event_id,
               md5(cast(forecast_timestamp_local as varchar) || '|' || ingest_time_utc) as record_key
        from aqi_feed""",
    "version_history": _history("forecast_timestamp_local"),
    "version_history_by_user": _history("user_id, forecast_timestamp_local"),
    "latest_version_aqi": f"{WITH_FEEDS} {_newest('aqi_feed', 'forecast_timestamp_local')}",
    "latest_version_weather": f"{WITH_FEEDS} {_newest('weather_feed', 'forecast_timestamp_local')}",
    "latest_version_by_user": f"{WITH_FEEDS} {_newest('aqi_feed', 'user_id, forecast_timestamp_local')}",
    "latest_shipment_version": """
        select * from lineitem
        qualify row_number() over (
            partition by l_partkey order by l_shipdate desc, l_orderkey desc, l_linenumber desc) = 1""",
    "gold_mart": f"{WITH_MART} select * from mart",
    "gold_mart_by_user": f"{WITH_USER_MART} select * from mart",
    "bronze_to_gold": f"""
        with a as ({_silver(AQI, AQI_OK)}), w as ({_nulled_weather()}) {_mart('a', 'w')}""",
    "materialize_mart": f"{WITH_MART} select * from mart",
    "catalog_mart": f"{WITH_MART} select * from mart",
    "dq_not_null": f"{WITH_MART} {_union(NOT_NULL)}",
    "dq_unique": f"{WITH_MART} "
    + _union(
        MART_UNIQUE
        + [
            _unique("stg_aqi_hourly", "aqi_feed", c)
            for c in ("forecast_timestamp_local", "user_id", "raw_file_name")
        ]
    ),
    "dq_accepted_values": f"{WITH_FEEDS} "
    + _union(
        ACCEPTED
        + [_accepted("events", "events", "event_type", "'click', 'view', 'purchase', 'signup'")]
    ),
    "dq_metric_range": f"{WITH_MART} select * from mart where {METRIC_RANGE}",
    "dq_weather_range": f"{WITH_MART} select * from mart where {WEATHER_RANGE}",
    "dq_hourly_gaps": _gaps(FEED_HOURS),
    "dq_hourly_gaps_repeats": _gaps(HOURS_BY_USER),
    "dq_hourly_gaps_by_user": _gaps(HOURS_BY_USER, "user_id, "),
    "dq_report": f"""{WITH_MART}
        select check_name, failing_rows, failing_rows = 0 as passed from ({_union(REPORT)})""",
    "mart_scan": f"{WITH_MART} select {HOURLY} from mart",
    "mart_scan_backfill": f"""{WITH_MART}
        select * exclude (record_key) replace (
            cast(null as double) as temperature_c, cast(null as double) as relative_humidity,
            cast(null as double) as wind_speed_kph) from mart""",
    "mart_scan_mixed": f"""{WITH_MART}
        select * exclude (record_key) replace (
            case when forecast_date_local >= date '2024-01-16' then temperature_c end as temperature_c,
            case when forecast_date_local >= date '2024-01-16' then relative_humidity end
                as relative_humidity,
            case when forecast_date_local >= date '2024-01-16' then wind_speed_kph end as wind_speed_kph)
        from mart""",
    "stored_window": f"{WITH_MART} select {HOURLY} from mart where {_in_window(*WINDOW)}",
    "date_window": f"{WITH_MART} select {HOURLY} from mart where {_in_window(*WINDOW)}",
    "single_date": f"{WITH_MART} select {HOURLY} from mart where {_in_window(WINDOW[0], WINDOW[0])}",
    "daily_summary": f"{WITH_MART} {_daily()}",
    "daily_summary_by_user": f"{WITH_USER_MART} {_daily('user_id,')}",
    "window_kpis": f"""{WITH_MART}
        select count(*) as hours, min(forecast_date_local) as min_date,
               max(forecast_date_local) as max_date, {_rounded('pm25')} as avg_pm25,
               max(us_aqi) as peak_aqi, max(last_ingested_at_utc) as last_ingested_at_utc
        from mart having count(*) > 0""",
    "peak_hour": f"{WITH_MART} select {HOURLY} from {PEAK}",
    "peak_hour_by_date": f"""{WITH_MART}
        select {HOURLY} from mart where us_aqi is not null
        qualify row_number() over (
            partition by forecast_date_local order by us_aqi desc, forecast_timestamp_local) = 1""",
    "current_hour": f"{WITH_MART} select {HOURLY} from {FIRST}",
    "current_delta": f"{WITH_MART} {DELTA}",
    "metric_options": f"{WITH_MART} {OPTIONS}",
    "melt_metrics": f"{WITH_MART} {LONG}",
    "melt_default_metric": f"""{WITH_MART}
        select forecast_timestamp_local, cast(us_aqi as double) as value, 'US AQI' as metric from mart""",
    "aqi_band": f"""
        select event_id, value as us_aqi, {_band('value', 'label')} as band_label,
               {_band('value', 'color')} as band_color, {_band('value', 'advisory')} as band_advisory
        from events""",
    "band_counts": f"""{WITH_MART}
        select {_band('us_aqi', 'label')} as band_label, count(*) as hours from mart group by 1""",
    "freshness": _fresh("event_type"),
    "freshness_by_user": _fresh("user_id"),
    "map_points": f"{WITH_MART} select latitude, longitude, us_aqi from {FIRST}",
    "status_rows": f"{WITH_MART} select * from ({STATUS}) where value is not null",
    "headline_cards": f"{WITH_MART} {CARDS}",
    "headline_cards_window": f"""
        with {FEEDS}, whole_mart as ({_mart('aqi_feed', 'weather_feed')}),
        mart as (select * from whole_mart where {_in_window(*WINDOW)}) {CARDS}""",
    "display_table": f"""{WITH_MART}
        select forecast_timestamp_local as forecast_time_local, us_aqi, pm25, pm10, temperature_c,
               relative_humidity, wind_speed_kph, last_ingested_at_utc as last_ingested_utc
        from mart""",
}
