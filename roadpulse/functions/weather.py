"""Weather classes, surfaces and hourly document fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numeric import rounded

# What replaces a missing or zero reading, per weather field,
# and the number of decimals each field is stored with.
HOURLY_DEFAULTS = {
    "temperature": 20.0,
    "precipitation": 0.0,
    "cloudcover": 0.0,
    "windspeed": 0.0,
    "visibility": 10000.0,
}
WEATHER_DIGITS = {
    "temperature": 1,
    "precipitation": 1,
    "cloudcover": 0,
    "windspeed": 1,
    "visibility": 0,
}


def weather_class_hist(precip: Column, cloud: Column, vis: Column) -> Column:
    """Six classes from archived readings; rain outranks cloud, cloud outranks fog."""
    return (
        F.when(precip > 5, "Heavy Rain")
        .when(precip > 1, "Rain")
        .when(precip > 0, "Light Rain")
        .when(cloud > 70, "Cloudy")
        .when(vis < 1000, "Fog")
        .otherwise("Clear")
    )


def weather_class_live(precip: Column) -> Column:
    """Four classes from the current precipitation."""
    return (
        F.when(precip > 5, "Heavy Rain")
        .when(precip > 0.5, "Rain")
        .when(precip > 0, "Light Rain")
        .otherwise("Clear")
    )


def is_rain(label: Column) -> Column:
    return label.contains("Rain")


def road_surface(precip: Column) -> Column:
    return F.when(precip > 0, "Wet").otherwise("Dry")


def road_surface_from_label(label: Column) -> Column:
    return F.when(is_rain(label), "Wet").otherwise("Dry")


def falsy_default(c: Column, default: float) -> Column:
    """A reading that is null or exactly zero counts as missing."""
    return F.when(c.isNull() | (c == 0), F.lit(default)).otherwise(c)


def midday(readings: Column, length: Column | None = None) -> Column:
    """Element 12 of an hourly array, or its last element when shorter."""
    size = F.size(readings) if length is None else length
    return F.get(readings, F.least(F.lit(12), size - 1))


def round_weather(df: DataFrame) -> DataFrame:
    """Store every weather field with its number of decimals."""
    return df.withColumns({c: rounded(F.col(c), n) for c, n in WEATHER_DIGITS.items()})
