"""Verdict on every raw document, in one pass and without Python functions.

Rules are tried in a fixed order and the first that fails names the verdict. A document that
passes all of them is ``ok``; anything else belongs in quarantine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.specs import Dataset

OK = "ok"
# Values stay text at first, so one odd element cannot null out its whole array.
DOCUMENT = "latitude string, longitude string, hourly map<string, array<string>>"


def with_verdict(docs: DataFrame, dataset: Dataset, payload: str = "payload") -> DataFrame:
    """``docs`` with ``verdict`` and ``detail`` (null for good documents)."""
    return _judged(docs, dataset, payload).select(*docs.columns, "_verdict.*")


def valid_documents(docs: DataFrame, dataset: Dataset, payload: str = "payload") -> DataFrame:
    """Documents that pass, without the verdict columns."""
    return with_verdict(docs, dataset, payload).where(F.col("verdict") == OK).select(*docs.columns)


def parse_valid_documents(
    docs: DataFrame, dataset: Dataset, payload: str = "payload"
) -> DataFrame:
    """Documents that pass, with ``latitude, longitude, hourly`` in place of the text.

    Checking and reading share one parse; what passed can be cast.
    """
    good = _judged(docs, dataset, payload).where(F.col("_verdict.verdict") == OK)
    kept = [c for c in docs.columns if c != payload]
    doc = F.col("_doc")
    arrays = [
        doc["hourly"][f.name].cast(f.dataType).alias(f.name)
        for f in dataset.document_schema["hourly"].dataType
    ]
    return good.select(
        *kept,
        doc["latitude"].cast("double").alias("latitude"),
        doc["longitude"].cast("double").alias("longitude"),
        F.struct(*arrays).alias("hourly"),
    )


def quarantine(docs: DataFrame, dataset: Dataset, payload: str = "payload") -> DataFrame:
    """Documents that fail, with the reason."""
    return with_verdict(docs, dataset, payload).where(F.col("verdict") != OK)


def _judged(docs: DataFrame, dataset: Dataset, payload: str) -> DataFrame:
    # Verdict and parsed document come out of a generator over a one-element array. That parses a
    # document once: with plain columns, a filter on the verdict would be pushed below them and
    # parse the document again.
    text = F.col(payload)

    def judge(doc: Column) -> Column:
        hourly = doc["hourly"]
        verdict = _bind(_lengths(hourly), lambda n: _verdict(doc, n, text, dataset))[0]
        return F.struct(verdict.alias("_verdict"), doc.alias("_doc"))

    return docs.select("*", F.inline(_bind(F.from_json(text, DOCUMENT), judge)))


def _lengths(hourly: Column) -> Column:
    # An array spelled null stands for a column of nulls and fits any length.
    given = F.filter(F.map_values(hourly), lambda a: a.isNotNull())
    return F.transform(given, lambda a: F.size(a))


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """One-element array of ``use(value)``, with ``value`` computed once."""
    return F.transform(F.array(value), use)


def _verdict(doc: Column, lengths: Column, payload: Column, dataset: Dataset) -> Column:
    hourly = doc["hourly"]
    section = F.get_json_object(payload, "$.hourly")
    # JSON texts of a section that is there but holds nothing.
    blank = ("{}", "[]", "", "0", "false")
    no_section = F.when(hourly.isNull(), section.isNull() | section.isin(*blank)).otherwise(
        F.size(hourly) == 0
    )
    unreadable = hourly.isNull() & ~F.startswith(
        F.coalesce(F.get_json_object(payload, "$"), F.lit("")), F.lit("{")
    )
    differ = F.array_min(lengths) != F.array_max(lengths)
    uneven = hourly.isNull() | (F.size(lengths) == 0) | differ

    required = F.array(*[F.lit(f) for f in dataset.required_fields])
    missing = F.array_join(F.array_sort(F.array_except(required, F.map_keys(hourly))), ", ")
    no_rows = F.array_max(lengths) == 0

    times = hourly["time"]
    bad_time = times.isNull() | F.exists(times, lambda t: t.try_cast("timestamp_ntz").isNull())
    has_value = F.lit(False)
    for field in dataset.reading_fields:
        present = F.exists(hourly[field], lambda v: v.isNotNull())
        has_value = has_value | F.coalesce(present, F.lit(False))

    odd = _no_number("double", doc["latitude"]) | _no_number("double", doc["longitude"])
    for reading in dataset.readings:
        some = F.exists(hourly[reading.field], _odd(reading.type))
        odd = odd | F.coalesce(some, F.lit(False))

    title = dataset.title
    rules = [
        ("unreadable", unreadable, F.lit(f"{title} is not a JSON object.")),
        ("missing_hourly", no_section, F.lit(f"{title} does not contain an hourly section.")),
        ("ragged_arrays", uneven, F.lit(f"{title} has hourly arrays of different lengths.")),
        (
            "missing_columns",
            missing != "",
            F.concat(F.lit(f"{title} is missing required columns: "), missing, F.lit(".")),
        ),
        ("empty", no_rows, F.lit(f"{title} has no hourly rows.")),
        ("invalid_timestamps", bad_time, F.lit(f"{title} contains invalid forecast timestamps.")),
    ]
    if dataset.needs_a_value:
        rules.append(
            (
                "no_metrics",
                ~has_value,
                F.lit(f"{title} does not contain any non-null AQI metrics."),
            )
        )
    rules.append(("invalid_readings", odd, F.lit(f"{title} contains readings or coordinates that are no numbers.")))
    first, *rest = rules
    choice = F.when(first[1], _reason(first[0], first[2]))
    for name, failed, detail in rest:
        choice = choice.when(failed, _reason(name, detail))
    return choice.otherwise(_reason(OK, F.lit(None).cast("string")))


def _no_number(type_name: str, text: Column) -> Column:
    """Is there a text that cannot become a number of that type?"""
    number = text.try_cast("double")
    fits = number.isNotNull()
    if type_name == "int":
        fits = fits & number.between(-2147483648, 2147483647)  # false for NaN, the greatest of all
    return text.isNotNull() & ~fits


def _odd(type_name: str) -> Callable[[Column], Column]:
    return lambda text: _no_number(type_name, text)


def _reason(name: str, detail: Column) -> Column:
    return F.struct(F.lit(name).alias("verdict"), detail.alias("detail"))
