"""The whole build: landing table to silver tables to mart, with checks in between."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from hazeline.operators.quality import (
    mart_checks,
    require_passing,
    staged_checks,
    with_outcome,
)
from hazeline.operators.validation import quarantine
from hazeline.plans.gold import gold_mart
from hazeline.plans.silver import silver_from_landing
from hazeline.sources.bronze import latest_landing, read_landing
from hazeline.sources.tables import MART, write_model
from hazeline.specs import AQI, DATE, HOUR, WEATHER


@dataclass(frozen=True)
class Build:
    """Stored tables of one build and the outcome of its checks."""

    staged_aqi: DataFrame
    staged_weather: DataFrame
    mart: DataFrame
    report: DataFrame


def build(
    spark: SparkSession, landing: str, warehouse: str, location: Sequence[str] = ()
) -> Build:
    """Full refresh: a failed silver check stops before the mart, a failed mart check raises.

    ``location`` names the columns that tell places apart if there are several, such as latitude
    and longitude. Checks run on the stored tables, so nothing is computed twice. Documents that do not pass
    validation are written to ``quarantine_<feed>`` and take no further part.
    """
    staged, reports = {}, []
    for feed in (AQI, WEATHER):
        docs = latest_landing(read_landing(spark, landing, feed))
        write_model(quarantine(docs, feed), f"{warehouse}/quarantine_{feed.name}", ("ingest_date",))
        name = f"stg_{feed.name}_hourly"
        rows = silver_from_landing(docs, feed)
        staged[feed.name] = write_model(rows, f"{warehouse}/{name}", (DATE,))
        reports.append(with_outcome(staged_checks(staged[feed.name], name, feed.source_system)))
    for report in reports:
        require_passing(report)

    gold = gold_mart(staged["aqi"], staged["weather"], (*location, HOUR))
    mart = write_model(gold, f"{warehouse}/{MART}", (DATE,))
    reports.append(with_outcome(mart_checks(mart, MART, location)))
    require_passing(reports[-1])
    report = reports[0].unionByName(reports[1]).unionByName(reports[2])
    return Build(staged["aqi"], staged["weather"], mart, report)
