"""All frames a dashboard over the mart shows, for one window of dates."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.operators import serving
from hazeline.sources.tables import served_columns
from hazeline.specs import HOUR


def views(
    mart: DataFrame,
    start: date | None = None,
    end: date | None = None,
    series: Sequence[str] | None = None,
    now: datetime | None = None,
) -> dict[str, DataFrame]:
    """Named frames. Which series can be shown is asked of the whole mart, the rest of the window.

    ``series`` are the metric keys to chart: all available ones by default, the index if empty.
    """
    hourly = served_columns(mart)
    options = serving.metric_option_map(hourly)
    chosen = list(options) if series is None else list(series)
    unknown = [s for s in chosen if s not in options]
    if unknown:
        raise ValueError(f"no such series: {', '.join(unknown)}")
    # only what is shown row by row is sorted
    window = serving.date_window(hourly, start, end)
    in_order = window.orderBy(F.col(HOUR).asc_nulls_last())
    return {
        "hourly": in_order,
        "options": serving.metric_options(hourly),
        "kpis": serving.window_kpis(window),
        "cards": serving.headline_cards(window),
        "status": serving.status_rows(window),
        "freshness": serving.freshness(window, now=now),
        "map": serving.map_points(window),
        "series": serving.melt_metrics(window, {s: options[s] for s in chosen}),
        "daily": serving.daily_summary(window),
        "records": serving.display_table(in_order),
    }
