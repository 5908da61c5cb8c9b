"""Queries over the event table, each relative to an explicit time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dashboard as d
from ..functions.numeric import rounded
from ..functions.risk import MAP_LEVELS, risk_level

# Lookbacks of the five queries, the dense-traffic bound, and the
# bin width of the trend.
LOOKBACKS = {
    "risk_heatmap": "15 minutes",
    "active_high_risk": "5 minutes",
    "risk_trend": "1 hour",
    "live_feed": "10 minutes",
    "weather_impact": "2 hours",
}
DENSE = 80
TREND_BIN = "5 minutes"
FEED_ROWS = 20


def latest(events: DataFrame) -> Column:
    """Newest event time as a scalar subquery, to stand for now."""
    return events.select(F.max("Timestamp")).scalar()


def recent(df: DataFrame, lookback: str, as_of: Column, ts: str = "Timestamp") -> DataFrame:
    """Rows newer than ``as_of`` minus the lookback, the bound itself excluded.

    Where the frame has ``event_date``, the partition column of event tables, older
    dates are not listed or read.
    """
    bound = as_of - F.expr(f"INTERVAL {lookback}")
    if "event_date" in df.columns:
        df = df.filter(F.col("event_date") >= F.to_date(bound))
    return df.filter(F.col(ts) > bound)


def dense(df: DataFrame, threshold: int = DENSE) -> DataFrame:
    return df.filter(F.col("TrafficDensity") >= threshold)


def alerts(df: DataFrame) -> DataFrame:
    return df.filter("AlertTriggered")


def mean_density() -> Column:
    return rounded(F.avg("TrafficDensity"), 1)


def mean_score() -> Column:
    return rounded(F.avg("RiskScore"), 3)


def high_share() -> Column:
    return rounded(d.percent_of(F.col("RiskLevel") == "High"), 1)


def heatmap_stats(events: DataFrame, as_of: Column, lookback: str = LOOKBACKS["risk_heatmap"]) -> DataFrame:
    """All computed columns of the map query, with level, colour and size."""
    place = ["LocationName", "RoadName", "Latitude", "Longitude"]
    grouped = recent(events, lookback, as_of).groupBy(*place).agg(
        F.count(F.lit(1)).alias("EventCount"),
        mean_density().alias("AvgDensity"),
        mean_score().alias("AvgRiskScore"),
        d.countif(F.col("RiskLevel") == "High").alias("HighRiskCount"),
        F.max("Timestamp").alias("LatestAlert"),
    )
    return grouped.withColumns(
        {
            "RiskLevel": risk_level(F.col("AvgRiskScore"), *MAP_LEVELS),
            "RiskColor": d.risk_colour(F.col("AvgRiskScore")),
            "Size": d.size_class(F.col("EventCount")),
        }
    )


def risk_heatmap(events: DataFrame, as_of: Column, lookback: str = LOOKBACKS["risk_heatmap"]) -> DataFrame:
    """Map points with title, description, colour and size."""
    return heatmap_stats(events, as_of, lookback).select(
        "Longitude",
        "Latitude",
        d.strcat(F.col("LocationName"), " - ", F.col("RoadName")).alias("Title"),
        d.strcat(
            "Density: ", d.tostring(F.col("AvgDensity")), "%, Risk: ", d.tostring(F.col("AvgRiskScore")),
            ", Events: ", d.tostring(F.col("EventCount")),
        ).alias("Description"),
        "RiskColor",
        "Size",
    )


def active_high_risk(events: DataFrame, as_of: Column, lookback: str = LOOKBACKS["active_high_risk"]) -> DataFrame:
    """Number of recent events in dense traffic, in one row."""
    return dense(recent(events, lookback, as_of)).agg(F.count(F.lit(1)).alias("HighRiskCount"))


def trend_columns() -> list[Column]:
    return [
        mean_density().alias("AvgDensity"),
        mean_score().alias("AvgRiskScore"),
        high_share().alias("HighRiskRate"),
        d.countif(F.col("AlertTriggered")).alias("AlertCount"),
    ]


def risk_trend(events: DataFrame, as_of: Column, lookback: str = LOOKBACKS["risk_trend"]) -> DataFrame:
    """Density, score, share of High and alerts by bin and road, in time order."""
    grouped = recent(events, lookback, as_of).groupBy(F.window("Timestamp", TREND_BIN).alias("bin"), "RoadName")
    return grouped.agg(*trend_columns()).select(
        F.col("bin.start").alias("Timestamp"), "RoadName", "AvgDensity", "AvgRiskScore", "HighRiskRate", "AlertCount"
    ).orderBy("Timestamp")


def weather_impact(events: DataFrame, as_of: Column, lookback: str = LOOKBACKS["weather_impact"]) -> DataFrame:
    """Counts, means and shares by weather, riskiest first."""
    return recent(events, lookback, as_of).groupBy("Weather").agg(
        F.count(F.lit(1)).alias("EventCount"),
        mean_density().alias("AvgDensity"),
        mean_score().alias("AvgRiskScore"),
        high_share().alias("HighRiskPercentage"),
        rounded(d.percent_of(F.col("AlertTriggered")), 1).alias("AlertRate"),
    ).orderBy(F.desc("AvgRiskScore"))


def live_feed(
    events: DataFrame, as_of: Column, lookback: str = LOOKBACKS["live_feed"], k: int = FEED_ROWS
) -> DataFrame:
    """Newest events, formatted for display; ties by EventId."""
    newest = recent(events, lookback, as_of).orderBy(F.desc("Timestamp"), F.asc("EventId")).limit(k)
    return newest.select(
        d.format_datetime(F.col("Timestamp")).alias("Time"),
        d.strcat(F.col("LocationName"), " (", F.col("RoadName"), ")").alias("Location"),
        F.col("TrafficDensity").alias("Density"),
        "Weather",
        "RiskLevel",
        rounded(F.col("RiskScore"), 2).alias("RiskScore"),
        rounded(F.col("Confidence"), 2).alias("Confidence"),
        d.alert_marker(F.col("AlertTriggered")).alias("Alert"),
        d.display_level(F.col("RiskLevel")).alias("RiskDisplay"),
    )


def coloured_feed(feed: DataFrame) -> DataFrame:
    """Live feed with the cell colour of its density."""
    return feed.withColumn("DensityColour", d.cell_colour(F.col("Density"), d.DENSITY_RULES))


def coloured_count(count: DataFrame) -> DataFrame:
    """Active high-risk card with its colour."""
    return count.withColumn("CountColour", d.cell_colour(F.col("HighRiskCount"), d.COUNT_RULES))


def run_stats(events: DataFrame, sent: Column | None = None) -> DataFrame:
    """Totals of a run: generated, sent, High, alerts, minutes between first and last event."""
    sent = F.lit(True) if sent is None else sent
    first, last = F.min("Timestamp"), F.max("Timestamp")
    minutes = (F.unix_micros(last) - F.unix_micros(first)) / F.lit(60e6)
    return events.agg(
        F.count(F.lit(1)).alias("events_generated"),
        F.count_if(sent).alias("events_sent"),
        F.count_if(F.col("RiskLevel") == "High").alias("high_risk_events"),
        F.count_if("AlertTriggered").alias("alerts_triggered"),
        rounded(minutes, 1).alias("elapsed_minutes"),
    )
