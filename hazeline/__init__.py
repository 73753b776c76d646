"""Hourly forecast versions on Spark: land, check, explode, keep the latest, serve."""

from hazeline.plans.build import build
from hazeline.plans.gold import gold_mart
from hazeline.plans.silver import silver_aqi, silver_from_landing, silver_weather
from hazeline.plans.views import views
from hazeline.sources.tables import load_hourly
from hazeline.specs import AQI, WEATHER
from hazeline.streaming.silver import stream_silver

__all__ = [
    "AQI",
    "WEATHER",
    "build",
    "gold_mart",
    "load_hourly",
    "silver_aqi",
    "silver_from_landing",
    "silver_weather",
    "stream_silver",
    "views",
]
