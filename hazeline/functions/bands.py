"""Air-quality bands as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazeline.specs import ABOVE_ALL_BANDS, AQI_BANDS, NO_BAND, Band


def aqi_band(aqi: Column) -> Column:
    """Struct of label, color and advisory.

    NaN is tested before the bounds because Spark orders it above every number.
    """
    value = aqi.cast("double")
    choice = F.when(value.isNull() | F.isnan(value), _as_struct(NO_BAND))
    for upper, band in AQI_BANDS:
        choice = choice.when(value <= upper, _as_struct(band))
    return choice.otherwise(_as_struct(ABOVE_ALL_BANDS))


def _as_struct(band: Band) -> Column:
    return F.struct(
        F.lit(band.label).alias("label"),
        F.lit(band.color).alias("color"),
        F.lit(band.advisory).alias("advisory"),
    )
