"""Text made for people: causes, factors, explanations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .calendar import is_rush_hour, is_rush_hour_live
from .weather import is_rain

# Wording of causes and factors, in output order.
CAUSES = {
    "wet": "Wet Road Surface",
    "fog": "Poor Visibility",
    "rush": "Heavy Traffic",
    "speeding": "Over-Speeding",
    "friday": "Rush Hour",
    "none": "Driver Error",
}
FACTORS = {
    "density": "High traffic density",
    "rain": "Adverse weather conditions",
    "rush": "Rush hour traffic",
    "place": "High-risk location",
    "none": "Normal traffic conditions",
}


def listed(parts: list[Column], empty: str) -> Column:
    """Comma list of the parts that are not null, or a fixed text when none is."""
    joined = F.concat_ws(", ", *parts)
    return F.when(joined == "", F.lit(empty)).otherwise(joined)


def primary_cause(weather: Column, hour: Column, accident_type: Column, day: Column) -> Column:
    return listed(
        [
            F.when(weather.isin("Rain", "Heavy Rain"), CAUSES["wet"]),
            F.when(weather == "Fog", CAUSES["fog"]),
            F.when(is_rush_hour(hour), CAUSES["rush"]),
            F.when(accident_type == "Speeding", CAUSES["speeding"]),
            F.when((day == "Friday") & (hour >= 17), CAUSES["friday"]),
        ],
        CAUSES["none"],
    )


def primary_factors(density: Column, weather: Column, hour: Column, base: Column) -> Column:
    return listed(
        [
            F.when(density >= 80, FACTORS["density"]),
            F.when(is_rain(weather), FACTORS["rain"]),
            F.when(is_rush_hour_live(hour), FACTORS["rush"]),
            F.when(base >= 0.7, FACTORS["place"]),
        ],
        FACTORS["none"],
    )


def explanation(method: str, level: Column, confidence: Column, density: Column, weather: Column) -> Column:
    """Two sentences, in the wording of the model or of the rules. Percentages round half to even."""
    traffic = F.concat(
        F.lit("Traffic density at "), density.cast("string"),
        F.lit("% with "), F.lower(weather), F.lit(" conditions"),
    )
    if method == "ML":
        percent = F.bround(confidence * 100, 0).cast("int").cast("string")
        model = F.concat(
            F.lit("ML model prediction: "), level, F.lit(" risk with "), percent, F.lit("% confidence")
        )
        return F.concat_ws(". ", model, traffic)
    return F.concat_ws(". ", traffic, F.lit("Risk assessment based on traffic patterns and weather impact"))
