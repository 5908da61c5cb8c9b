"""Risk scores, levels, probabilities and alerts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .calendar import is_rush_hour_live
from .numeric import between_draw, clip
from .weather import is_rain

# Level thresholds (High, Medium) of the three places that use them.
HISTORY_LEVELS = (0.75, 0.50)
LIVE_LEVELS = (0.75, 0.45)
MAP_LEVELS = (0.70, 0.50)

# Score of each severity and of each predicted class.
SEVERITY_SCORES = {"Fatal": 1.0, "Serious": 0.7, "Minor": 0.3}
SEVERITY_DEFAULT = 0.5
CLASS_SCORES = {"Low": 0.3, "Medium": 0.6, "High": 0.9}
CLASS_SCORE_DEFAULT = 0.5
CLASS_PROB_DEFAULTS = {"High": 0.1, "Medium": 0.3, "Low": 0.6}

# Bands of the rule mode: confidence per level, and per level the
# bands of the two drawn probabilities (the third is the residual).
CONFIDENCE_BANDS = {"High": (0.85, 0.95), "Medium": (0.70, 0.85), "Low": (0.60, 0.80)}
PROBABILITY_BANDS = {
    "High": {"High": (0.7, 0.9), "Medium": (0.1, 0.3)},
    "Medium": {"Medium": (0.5, 0.7), "High": (0.1, 0.3)},
    "Low": {"Low": (0.6, 0.8), "High": (0.05, 0.15)},
}

# Holiday factor and acceptance factor of the accident history.
HOLIDAY_FACTOR = 0.8
ACCIDENT_RATE = 0.15


def pick(c: Column, mapping: dict, default) -> Column:
    """Value of a small fixed mapping as a CASE expression."""
    out = None
    for key, value in mapping.items():
        test = c == key
        out = F.when(test, F.lit(value)) if out is None else out.when(test, F.lit(value))
    return out.otherwise(F.lit(default))


def risk_level(score: Column, hi: float = 0.75, mid: float = 0.50) -> Column:
    return F.when(score >= hi, "High").when(score >= mid, "Medium").otherwise("Low")


def risk_score(base: Column, time: Column, day: Column, weather: Column, holiday: Column) -> Column:
    """Multiplicative history score, at most 1."""
    factor = F.when(holiday, HOLIDAY_FACTOR).otherwise(1.0)
    return F.least(base * time * day * weather * factor, F.lit(1.0))


def accident_probability(score: Column) -> Column:
    return score * F.lit(ACCIDENT_RATE)


def severity_weights(score: Column) -> Column:
    """Unnormalised weights of Fatal, Serious and Minor for a score."""
    return F.struct(
        F.greatest(F.lit(0.03), score * 0.08).alias("fatal"),
        F.greatest(F.lit(0.15), score * 0.30).alias("serious"),
        (F.lit(1.0) - F.greatest(F.lit(0.18), score * 0.38)).alias("minor"),
    )


def severity_probabilities(score: Column) -> Column:
    """Weights of :func:`severity_weights` scaled to sum 1."""
    w = severity_weights(score)
    total = w["fatal"] + w["serious"] + w["minor"]
    return F.struct(*[(w[k] / total).alias(k) for k in ("fatal", "serious", "minor")])


def density_estimate(score: Column, noise: Column | int = 0) -> Column:
    """Traffic density from 10 to 100."""
    noise = noise if isinstance(noise, Column) else F.lit(noise)
    return clip((F.lit(50.0) + score * 40.0 + noise).cast("int"), 10, 100)


def speed_estimate(limit: Column, density: Column, noise: Column | int = 0) -> Column:
    """Average speed from 10 to ten above the limit; denser traffic is slower."""
    noise = noise if isinstance(noise, Column) else F.lit(noise)
    free = F.lit(0.3) + F.lit(0.7) * (F.lit(1.0) - density / 100.0)
    raw = (limit * free + noise).cast("int")
    return F.greatest(F.lit(10), F.least(limit + 10, raw))


def severity_score(severity: Column) -> Column:
    return pick(severity, SEVERITY_SCORES, SEVERITY_DEFAULT)


def rule_score(density: Column, weather: Column, hour: Column, base: Column) -> Column:
    """Live score without a model: density, rain, rush hour and place, at most 1."""
    rain = F.when(is_rain(weather), 1.5).otherwise(1.0)
    rush = F.when(is_rush_hour_live(hour), 1.3).otherwise(1.0)
    return F.least(F.lit(1.0), density / 100.0 * rain * rush * base)


def expected_score(probs: Column, classes: list[str]) -> Column:
    """Probability-weighted class score; ``probs`` is an array in class order."""
    total = F.lit(0.0)
    for i, name in enumerate(classes):
        total = total + probs[i] * F.lit(CLASS_SCORES.get(name, CLASS_SCORE_DEFAULT))
    return total


def rule_confidence(level: Column, key: Column) -> Column:
    """Confidence of a rule decision: a keyed draw from the band of its level."""
    out = None
    for name, (lo, hi) in CONFIDENCE_BANDS.items():
        value = between_draw(key, ":confidence", lo, hi)
        out = F.when(level == name, value) if out is None else out.when(level == name, value)
    return out


def model_confidence(probs: Column, predicted: Column, classes: list[str]) -> Column:
    """Probability of the predicted class."""
    out = F.lit(None).cast("double")
    for i, name in enumerate(classes):
        out = F.when(predicted == name, probs[i]).otherwise(out)
    return out


def rule_probs(level: Column, key: Column) -> Column:
    """High, Medium, Low probabilities of a rule decision.

    Two are keyed draws from bands, the third is what remains; the remainder can
    be negative and is kept, with ``invalid`` telling so.
    """

    def for_level(name: str) -> Column:
        drawn = {
            k: between_draw(key, f":{k.lower()}", lo, hi)
            for k, (lo, hi) in PROBABILITY_BANDS[name].items()
        }
        residual = F.lit(1.0)
        for value in drawn.values():
            residual = residual - value
        full = {k: drawn.get(k, residual) for k in ("High", "Medium", "Low")}
        return F.struct(
            full["High"].alias("high"),
            full["Medium"].alias("medium"),
            full["Low"].alias("low"),
            (residual < 0).alias("invalid"),
        )

    return (
        F.when(level == "High", for_level("High"))
        .when(level == "Medium", for_level("Medium"))
        .otherwise(for_level("Low"))
    )


def model_probs(probs: Column, classes: list[str]) -> Column:
    """High, Medium, Low probabilities of a model; classes it lacks take defaults."""

    def of(name: str) -> Column:
        default = F.lit(CLASS_PROB_DEFAULTS[name])
        return F.coalesce(probs[classes.index(name)], default) if name in classes else default

    return F.struct(
        of("High").alias("high"),
        of("Medium").alias("medium"),
        of("Low").alias("low"),
        F.lit(False).alias("invalid"),
    )


def alert(level: Column, confidence: Column, density: Column) -> Column:
    """A sure High, or traffic of 90 and more."""
    return ((level == "High") & (confidence > 0.8)) | (density >= 90)


def serving_factors(rush: Column, weather: Column, weekend: Column) -> dict[str, Column]:
    """Simplified factors used when features are built from a live event."""
    return {
        "time_risk_factor": F.when(rush, 1.5).otherwise(1.0),
        "weather_risk_factor": F.when(is_rain(weather), 1.8).otherwise(1.0),
        "day_risk_factor": F.when(weekend, 0.7).otherwise(1.0),
    }
