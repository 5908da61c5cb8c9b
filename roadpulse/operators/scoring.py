"""Scoring of live events, by rules or by a trained model, for batch and stream."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import is_rush_hour_live, is_weekend
from ..functions.numeric import rounded
from ..functions.risk import (
    LIVE_LEVELS, alert, expected_score, model_confidence, model_probs, risk_level, rule_confidence, rule_probs,
    rule_score, serving_factors,
)
from ..functions.text import explanation, primary_factors
from ..functions.weather import is_rain, road_surface_from_label
from ..schemas import EVENT_SCHEMA, conform
from . import history

# What live events do not carry, as the reference mode fills it in.
SERVING_DEFAULTS = {
    "latitude": -1.2921,
    "longitude": 36.8219,
    "temperature": 25.0,
    "rain_precipitation": 1.0,
    "cloudcover": 50.0,
    "windspeed": 10.0,
    "speed_limit": 60,
    "lanes": 4,
    "road_type": "main_road",
    "average_speed": 40,
}

# Columns a raw event needs; base_risk may come from the profile instead.
RAW_COLUMNS = ("EventId", "Timestamp", "LocationName", "RoadName", "TrafficDensity", "Weather")


def with_base_risk(events: DataFrame, profile: DataFrame) -> DataFrame:
    """Place and base risk of every raw event, from the location profile."""
    place = profile.select(
        F.col("location_name").alias("LocationName"), F.col("road_name").alias("RoadName"),
        F.col("latitude").alias("Latitude"), F.col("longitude").alias("Longitude"), "base_risk",
    )
    return events.join(place, ["LocationName", "RoadName"])


def rule_columns(events: DataFrame) -> DataFrame:
    """Unrounded rule decision: level, score, probabilities, confidence."""
    density, weather = F.col("TrafficDensity"), F.col("Weather")
    scored = events.withColumn("score", rule_score(density, weather, F.col("Hour"), F.col("base_risk")))
    levelled = scored.withColumn("level", risk_level(F.col("score"), *LIVE_LEVELS))
    return levelled.withColumns(
        {"probs": rule_probs(F.col("level"), F.col("EventId")), "conf": rule_confidence(F.col("level"), F.col("EventId"))}
    )


def model_columns(events: DataFrame, model: PipelineModel, mode: str) -> DataFrame:
    """Unrounded model decision, with the same columns as the rule decision."""
    classes = model_classes(model)
    predicted = model.transform(serving_features(events, mode))
    level = F.element_at(F.array(*[F.lit(c) for c in classes]), (F.col("prediction") + 1).cast("int"))
    decided = predicted.select("event", class_probabilities(predicted).alias("p"), level.alias("level"))
    return decided.select(
        "event.*",
        "level",
        expected_score(F.col("p"), classes).alias("score"),
        model_probs(F.col("p"), classes).alias("probs"),
        model_confidence(F.col("p"), F.col("level"), classes).alias("conf"),
    )


def class_probabilities(predicted: DataFrame) -> Column:
    """Probability array of a prediction; raw scores are scaled by softmax where a model has no more."""
    if "probability" in predicted.columns:
        return vector_to_array("probability")
    raw = vector_to_array("rawPrediction")
    top = F.array_max(raw)
    powers = F.transform(raw, lambda x: F.exp(x - top))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda a, b: a + b))


def model_classes(model: PipelineModel) -> list[str]:
    """Class names of a pipeline, in the order of its probability vector."""
    for stage in model.stages:
        if stage.hasParam("outputCol") and stage.isSet("outputCol") and stage.getOutputCol() == "label":
            return list(stage.labels)
    raise ValueError("the pipeline has no label indexer")


def score_events(
    events: DataFrame,
    profile: DataFrame | None = None,
    model: PipelineModel | None = None,
    mode: str = "reference",
) -> DataFrame:
    """Raw events to the 20 columns of the event table.

    Stateless, so the same call serves tables and streams. Without a model the
    rules decide; all draws are keyed by EventId.
    """
    placed = events if profile is None else with_base_risk(events, profile)
    timed = placed.withColumn("Hour", F.hour("Timestamp"))
    decided = rule_columns(timed) if model is None else model_columns(timed, model, mode)
    method = "RuleBased" if model is None else "ML"
    density, weather, level, conf = (F.col(c) for c in ("TrafficDensity", "Weather", "level", "conf"))
    triggered = alert(level, conf, density)
    prediction = F.col("PredictionId") if "PredictionId" in events.columns else F.uuid()
    full = decided.select(
        prediction.alias("PredictionId"), "Timestamp", "EventId", "LocationName", "RoadName",
        "Latitude", "Longitude", level.alias("RiskLevel"), rounded(F.col("score"), 4).alias("RiskScore"),
        rounded(F.col("probs.high"), 4).alias("RiskProbabilityHigh"),
        rounded(F.col("probs.medium"), 4).alias("RiskProbabilityMedium"),
        rounded(F.col("probs.low"), 4).alias("RiskProbabilityLow"),
        rounded(conf, 4).alias("Confidence"),
        primary_factors(density, weather, F.col("Hour"), F.col("base_risk")).alias("PrimaryFactors"),
        explanation(method, level, conf, density, weather).alias("AIExplanation"),
        "TrafficDensity", "Weather", "Hour", triggered.alias("AlertTriggered"),
        F.when(triggered, F.col("Timestamp")).alias("AlertSentTime"),
    )
    return conform(full, EVENT_SCHEMA)


def new_ids(df: DataFrame) -> DataFrame:
    """Fresh identifiers; for ingestion only, as every run draws new ones."""
    return df.withColumns({"PredictionId": F.uuid(), "EventId": F.uuid()})


def serving_features(events: DataFrame, mode: str = "reference") -> DataFrame:
    """Candidate features of live events.

    ``reference`` fills what an event lacks with the fixed values above and the
    simplified factors. ``aligned`` uses the event's own coordinates and the
    factor tables the model was trained with.
    """
    if mode not in ("reference", "aligned"):
        raise ValueError(f"unknown mode: {mode}")
    hour, weather = F.col("Hour"), F.col("Weather")
    day = F.date_format("Timestamp", "EEEE")
    rush, weekend, rain = is_rush_hour_live(hour), is_weekend(day), is_rain(weather)
    fixed = SERVING_DEFAULTS
    reference = mode == "reference"
    features = {
        "hour": hour,
        "month": F.month("Timestamp"),
        "day_of_week": day,
        "is_weekend": weekend,
        "is_rush_hour": rush,
        "is_holiday": F.lit(False),
        "latitude": F.lit(fixed["latitude"]) if reference else F.col("Latitude"),
        "longitude": F.lit(fixed["longitude"]) if reference else F.col("Longitude"),
        "base_location_risk": F.col("base_risk"),
        "speed_limit": F.lit(fixed["speed_limit"]),
        "lanes": F.lit(fixed["lanes"]),
        "road_type": F.lit(fixed["road_type"]),
        "weather": weather,
        "temperature": F.lit(fixed["temperature"]),
        "precipitation": F.when(rain, fixed["rain_precipitation"]).otherwise(0.0),
        "cloudcover": F.lit(fixed["cloudcover"]),
        "windspeed": F.lit(fixed["windspeed"]),
        "road_surface": road_surface_from_label(weather),
        "traffic_density": F.col("TrafficDensity"),
        "average_speed": F.lit(fixed["average_speed"]),
    }
    if reference:
        features.update(serving_factors(rush, weather, weekend))
    # The event itself travels in a struct: feature names differ from its columns only by case.
    built = events.select(
        F.struct(*events.columns).alias("event"), *[c.alias(n) for n, c in features.items()]
    )
    return built if reference else history.with_risk_factors(built)


def feature_row(df: DataFrame, names: list[str]) -> DataFrame:
    """Features in stored order; a missing feature is 0."""
    have = {c.lower() for c in df.columns}
    zero = F.lit(0.0)
    ordered: list[Column] = [
        (F.coalesce(F.col(n).cast("double"), zero) if n.lower() in have else zero).alias(n) for n in names
    ]
    return df.select(*ordered)
