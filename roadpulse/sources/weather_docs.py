"""Hourly weather documents, landed as JSON, to one row per date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.weather import (
    HOURLY_DEFAULTS, falsy_default, midday, road_surface, round_weather, weather_class_hist,
)
from ..schemas import WEATHER_DAY_SCHEMA, WEATHER_DOC_SCHEMA, conform
from . import dims

# Document field of each reading.
HOURLY_FIELDS = {
    "temperature": "temperature_2m",
    "precipitation": "precipitation",
    "cloudcover": "cloudcover",
    "windspeed": "windspeed_10m",
    "visibility": "visibility",
}


def read_weather_docs(spark: SparkSession, path: str) -> DataFrame:
    """Landed documents to daily weather."""
    return weather_days(spark.read.schema(WEATHER_DOC_SCHEMA).json(path))


def weather_days(docs: DataFrame) -> DataFrame:
    """Midday reading of every document.

    A document without hourly readings takes the defaults of the undated month. One whose
    readings lack the hour asked for, or a whole field, takes those of its own month.
    """
    has_hours = F.col("hourly").isNotNull()
    length = F.size(F.col("hourly.temperature_2m"))
    sizes = [F.coalesce(F.size(F.col(f"hourly.{field}")), F.lit(0)) for field in HOURLY_FIELDS.values()]
    whole = F.least(*sizes) > F.greatest(F.least(F.lit(12), F.coalesce(length, F.lit(0)) - 1), F.lit(0))
    readings = docs.select(
        "date",
        has_hours.alias("has_hours"),
        whole.alias("whole"),
        *[
            falsy_default(midday(F.col(f"hourly.{field}"), length), HOURLY_DEFAULTS[name]).alias(name)
            for name, field in HOURLY_FIELDS.items()
        ],
    )
    # Classes come from the readings as measured, before rounding.
    classed = readings.withColumns(
        {
            "weather": weather_class_hist(F.col("precipitation"), F.col("cloudcover"), F.col("visibility")),
            "road_surface": road_surface(F.col("precipitation")),
        }
    )
    defaults = [dims.month_default(m) for m in range(1, 13)]
    month = F.when(F.col("has_hours"), F.month(F.to_date("date"))).otherwise(dims.UNDATED_MONTH)
    filled = round_weather(classed).withColumns(
        {
            c: F.when(F.col("has_hours") & F.col("whole"), F.col(c)).otherwise(
                F.element_at(F.array(*[F.lit(d[c]) for d in defaults]), month)
            )
            for c in defaults[0]
        }
    )
    return conform(filled, WEATHER_DAY_SCHEMA)
