"""Continuous forms of the dashboard queries, and state kept up to date."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import dashboard as d
from ..functions.numeric import rounded, uniform01
from ..functions.risk import MAP_LEVELS, risk_level
from ..functions.weather import weather_class_live
from ..operators.dashboard import TREND_BIN, trend_columns
from ..operators.history import WEATHER_MAX_AGE, weather_asof

# How long the bins of a stream wait for late events. Later ones still reach
# the event table, which has no watermark.
WATERMARK = "10 minutes"

# Cumulative shares of the weather that stands in for a missing observation.
FALLBACK_WEATHER = ((0.7, "Clear"), (0.9, "Light Rain"), (1.0, "Rain"))


def trend_stream(events: DataFrame, watermark: str = WATERMARK, width: str = TREND_BIN) -> DataFrame:
    """Trend by bin and road; a bin is emitted once the watermark has passed it."""
    binned = events.withWatermark("Timestamp", watermark).groupBy(F.window("Timestamp", width).alias("bin"), "RoadName")
    return binned.agg(*trend_columns()).select(
        F.col("bin.start").alias("Timestamp"), "RoadName", "AvgDensity", "AvgRiskScore", "HighRiskRate", "AlertCount"
    )


def sliding_risk(
    events: DataFrame, width: str = "15 minutes", slide: str = "1 minute", watermark: str = WATERMARK
) -> DataFrame:
    """Map statistics of a sliding window, refreshed every slide; ``width`` is a multiple of ``slide``.

    Events are first added up in panes of one slide. Windows are made of closed panes, so what is copied to every
    window it lies in is a pane's sums, not each event. Both steps emit what the watermark has passed (append mode).
    """
    place = ["LocationName", "RoadName", "Latitude", "Longitude"]
    sums = [("TrafficDensity", "density"), ("RiskScore", "score")]
    panes = events.withWatermark("Timestamp", watermark).groupBy(F.window("Timestamp", slide).alias("pane"), *place).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(c).alias(f"{name}_sum") for c, name in sums],
        *[F.count(c).alias(f"{name}_n") for c, name in sums],
    )
    windows = panes.groupBy(F.window(F.window_time("pane"), width, slide).alias("span"), *place)
    mean = {name: F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n")) for _, name in sums}
    return windows.agg(
        F.sum("n").alias("EventCount"), rounded(mean["density"], 1).alias("AvgDensity"), rounded(mean["score"], 3).alias("AvgRiskScore")
    ).select(
        F.col("span.end").alias("WindowEnd"), *place, "EventCount", "AvgDensity", "AvgRiskScore",
        risk_level(F.col("AvgRiskScore"), *MAP_LEVELS).alias("RiskLevel"),
        d.risk_colour(F.col("AvgRiskScore")).alias("RiskColor"),
        d.size_class(F.col("EventCount")).alias("Size"),
    )


def stats_stream(events: DataFrame) -> DataFrame:
    """Running totals; every micro-batch emits the row anew."""
    return events.agg(
        F.count(F.lit(1)).alias("events_generated"),
        F.count_if(F.col("RiskLevel") == "High").alias("high_risk_events"),
        F.count_if("AlertTriggered").alias("alerts_triggered"),
    )


def start_snapshots(
    df: DataFrame, out: str, checkpoint: str, mode: str = "update", once: bool = False, every: str = "8 seconds"
) -> StreamingQuery:
    """Write what each micro-batch emits to its own folder.

    A batch that is run again replaces its folder, so a retry leaves no duplicates.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)
    return writer.start()


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """Rows of the last batch of :func:`start_snapshots`."""
    return snapshots.filter(F.col("batch") == snapshots.select(F.max("batch")).scalar()).drop("batch")


def fallback_weather(key: str) -> Column:
    """Weather that stands in for a missing observation: a keyed draw."""
    draw = uniform01(F.col(key), ":weather")
    *steps, (_, last) = FALLBACK_WEATHER
    return d.case([(draw < bound, label) for bound, label in steps], last)


def with_current_weather(
    events: DataFrame, observations: DataFrame, max_age: int = WEATHER_MAX_AGE, key: str = "EventId", **bounds
) -> DataFrame:
    """Weather class of every event from the last current observation, else the stand-in.

    ``observations`` has obs_ts, precipitation and temperature.
    """
    found = weather_asof(events.drop("Weather"), observations, max_age, event_key=key, **bounds)
    label = F.when(F.col("obs_ts").isNotNull(), weather_class_live(F.col("precipitation")))
    return found.withColumn("Weather", F.coalesce(label, fallback_weather(key)))


def in_span(observations: DataFrame, first, last, max_age: int = WEATHER_MAX_AGE) -> DataFrame:
    """Observations that can be current for events from ``first`` to ``last``; none without events."""
    since = F.lit(first).cast("timestamp") - F.expr(f"INTERVAL {max_age} SECONDS")
    return observations.filter(F.col("obs_ts").between(since, F.lit(last).cast("timestamp")))


def start_with_weather(
    events: DataFrame,
    read_weather: Callable[[], DataFrame],
    out: str,
    checkpoint: str,
    once: bool = False,
) -> StreamingQuery:
    """Attach the current weather; observations are read anew for every micro-batch, those of the batch's span only."""

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        span = batch.agg(F.min("Timestamp").alias("first"), F.max("Timestamp").alias("last")).first()
        current = in_span(read_weather(), span["first"], span["last"])
        with_current_weather(batch, current).write.mode("overwrite").parquet(f"{out}/batch={number}")
        batch.unpersist()

    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{WEATHER_MAX_AGE} seconds")
    return writer.start()
