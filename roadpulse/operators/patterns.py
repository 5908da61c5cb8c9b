"""Accident patterns, location risk profiles and watch lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import clip
from ..functions.risk import severity_score
from ..sources import dims
from .ordering import top_n

# What stands for a missing peak hour or weekday, the profile
# weights and bounds, and the number of watched locations.
PEAK_DEFAULTS = (12, "Monday")
PROFILE_WEIGHTS = (0.3, 0.4, 0.3)
PROFILE_BOUNDS = (0.3, 0.95)
WATCHED = 12

# What a pattern is made for, and the names it has in the result.
PATTERN_KEYS = {"location": "LocationName", "road_name": "RoadName", "latitude": "Latitude", "longitude": "Longitude"}


def most_frequent(c: Column, default) -> Column:
    """Most frequent value of a column, the smallest on ties, whatever values it has.

    The state is a count per value, combined before the shuffle.
    """
    return F.coalesce(F.mode(c, True), F.lit(default))


def max_date(df: DataFrame, date: str = "date") -> Column:
    """Latest date of a table as a scalar subquery."""
    return df.select(F.max(F.to_date(date))).scalar()


def last_days(df: DataFrame, n: int, date: str = "date") -> DataFrame:
    """Rows of the last date and the ``n`` days before it (ISO date text)."""
    cutoff = F.date_format(F.date_sub(max_date(df, date), n), "yyyy-MM-dd")
    return df.filter(F.col(date) >= cutoff)


def recent_counts(accidents: DataFrame, n: int = 7) -> DataFrame:
    """Accidents by known location in the last days."""
    return last_days(accidents, n).filter("location IS NOT NULL").groupBy("location").agg(F.count(F.lit(1)).alias(f"AccidentCount_{n}d"))


def location_patterns(accidents: DataFrame, strict_30d: bool = False, updated_at: str | None = None) -> DataFrame:
    """Counts, mean risk, last date and peak times of every location.

    The two ``30d`` counts cover the whole history, as published; with
    ``strict_30d`` they cover the last 30 days. The 7-day count is per location
    name and repeats where a name has several coordinates.
    """
    base = last_days(accidents, 30) if strict_30d else accidents
    known = base.filter(" and ".join(f"{k} is not null" for k in PATTERN_KEYS))
    grouped = known.groupBy(*[F.col(k).alias(v) for k, v in PATTERN_KEYS.items()]).agg(
        F.count("accident_id").alias("AccidentCount_30d"),
        F.count_if(F.col("severity") == "Fatal").alias("FatalCount_30d"),
        F.avg("risk_score").alias("AvgRiskScore"),
        # As a date the maximum fits a hash aggregate; as text it would sort all rows.
        F.date_format(F.max(F.to_date("date")), "yyyy-MM-dd").alias("LastAccidentDate"),
        most_frequent(F.col("hour"), PEAK_DEFAULTS[0]).alias("PeakRiskHour"),
        most_frequent(F.col("day_of_week"), PEAK_DEFAULTS[1]).alias("PeakRiskDay"),
    )
    weekly = recent_counts(accidents, 7).withColumnRenamed("location", "LocationName")
    return pattern_rows(grouped.join(weekly, "LocationName", "left").na.fill(0, ["AccidentCount_7d"]), updated_at)


def pattern_rows(counted: DataFrame, updated_at: str | None) -> DataFrame:
    """Columns of the pattern table, with the time of the update."""
    stamp = F.lit(updated_at) if updated_at else F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    return counted.select(
        *PATTERN_KEYS.values(), "AccidentCount_7d", "AccidentCount_30d", "FatalCount_30d", "AvgRiskScore",
        "LastAccidentDate", "PeakRiskHour", "PeakRiskDay", stamp.alias("UpdatedAt"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequencies, most frequent first."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), F.asc(column))


def location_profile(accidents: DataFrame, key: str = "id") -> DataFrame:
    """Base risk of every (location, road) from frequency, severity and score.

    One pass by (location, road); counts by location are a window over its
    result, which has few rows per location.
    """
    first = {c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col(key))) for c in ("latitude", "longitude")}
    pairs = (
        accidents.filter("location is not null")
        .groupBy("location", "road_name")
        .agg(
            *[c.alias(n) for n, c in first.items()],
            F.avg(severity_score(F.col("severity"))).alias("severity_score"),
            F.avg("risk_score").alias("risk_score"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    return profile_rows(pairs)


def profile_rows(pairs: DataFrame) -> DataFrame:
    """Base risk of pairs of location and road that have their means and counts."""
    by_location = Window.partitionBy("location")
    counted = pairs.withColumn("accident_count", F.sum("n").over(by_location)).filter("road_name is not null")
    most = counted.select(F.max("accident_count")).scalar()
    w_count, w_severity, w_risk = PROFILE_WEIGHTS
    risk = (
        F.col("accident_count") / most * w_count
        + F.col("severity_score") * w_severity
        + F.col("risk_score") * w_risk
    )
    return counted.select(
        F.col("location").alias("location_name"), "road_name", "latitude", "longitude",
        clip(risk, *PROFILE_BOUNDS).alias("base_risk"),
    )


def profile_or_fallback(accidents: DataFrame | None, spark) -> DataFrame:
    """Profile of the history, or the fixed locations when there is none to read."""
    needed = {"location", "road_name", "latitude", "longitude", "severity", "risk_score"}
    if accidents is None or not needed <= set(accidents.columns):
        return dims.fallback_locations(spark)
    return location_profile(accidents)


def watchlist(profile: DataFrame, k: int = WATCHED) -> DataFrame:
    """The ``k`` locations with the highest base risk."""
    return top_n(profile, [F.desc("base_risk"), F.asc("location_name"), F.asc("road_name")], k)


def on_watchlist(events: DataFrame, watched: DataFrame) -> DataFrame:
    """Events at watched locations."""
    names = watched.select(
        F.col("location_name").alias("__location"), F.col("road_name").alias("__road")
    ).distinct()
    match = (F.col("LocationName") == F.col("__location")) & (F.col("RoadName") == F.col("__road"))
    # At most WATCHED rows.
    return events.join(F.broadcast(names), match, "left_semi")


def score_share(df: DataFrame, column: str, name: str = "share") -> DataFrame:
    """Value as a share of the largest value."""
    return df.withColumn(name, F.try_divide(F.col(column), df.select(F.max(column)).scalar()))
