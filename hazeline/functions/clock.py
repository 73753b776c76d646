"""Hours, ingest times and text forms of zone-less timestamps.

All of these work on ``timestamp_ntz`` directly, so results do not depend on the session
zone or on its clock changes.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how ingest times are written in file names.
INGEST_PATTERN = "yyyyMMdd'T'HHmmss'Z'"


def naive_literal(moment: datetime) -> Column:
    """A ``timestamp_ntz`` literal; a moment with a zone is first put into UTC."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def hour_floor(ts: Column) -> Column:
    """Start of the hour, still zone-less (``date_trunc`` would return a zoned type)."""
    past_the_hour = F.make_dt_interval(
        F.lit(0), F.lit(0), F.minute(ts), F.extract(F.lit("SECOND"), ts)
    )
    return ts - past_the_hour


def hours_crossed(start: Column, end: Column) -> Column:
    """Number of hour boundaries between two times, so 00:59 to 01:01 counts as 1."""
    span = hour_floor(end) - hour_floor(start)
    return span.cast("interval hour").cast("bigint")


def minute_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm``."""
    return F.substring(ts.cast("string"), 1, 16)


def document_time(ts: Column) -> Column:
    """``yyyy-MM-ddTHH:mm``, the way documents spell their hours."""
    return F.replace(minute_text(ts), F.lit(" "), F.lit("T"))


def ingest_text(ts: Column) -> Column:
    """``yyyyMMddTHHmmssZ``."""
    day = F.year(ts) * 10000 + F.month(ts) * 100 + F.day(ts)
    time = F.hour(ts) * 10000 + F.minute(ts) * 100 + F.second(ts)
    return F.concat(_digits(day, 8), F.lit("T"), _digits(time, 6), F.lit("Z"))


def _digits(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def ingest_instant(text: Column) -> Column:
    """Ingest text back to a zone-less UTC time; other text is an error."""
    return F.to_timestamp_ntz(text, F.lit(INGEST_PATTERN))


def as_utc(ts: Column, type_name: str) -> Column:
    """Zoned instant of a column; a zone-less one is taken to be UTC.

    Goes by way of text: by way of the session zone, the hour that a clock change repeats there
    would stand for two instants.
    """
    if type_name == "timestamp_ntz":
        return F.concat(ts.cast("string"), F.lit("Z")).cast("timestamp")
    return ts


def as_naive_utc(ts: Column, type_name: str) -> Column:
    """Zone-less UTC time of a column; a zoned one is converted by its distance to the epoch."""
    if type_name == "timestamp":
        micros = F.unix_micros(ts).cast("decimal(19,0)")
        seconds = (micros * F.lit("0.000001").cast("decimal(6,6)")).cast("decimal(18,6)")
        return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return ts


def is_stale(last_ingested_utc: Column, now: Column, max_age) -> Column:
    """Older than ``max_age`` (exactly that old is still fresh); no time at all is stale."""
    return F.coalesce((now - last_ingested_utc) > F.lit(max_age), F.lit(True))
