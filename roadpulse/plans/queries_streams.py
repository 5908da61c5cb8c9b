"""Streaming queries: the events table as landed JSON, read until it is used up.

Each stream's table is compared with the batch SQL of the same question.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import scoring
from ..schemas import EVENT_SCHEMA
from ..session import scratch_path
from ..sources import tables
from ..streaming import ingest, summaries
from . import oracle_views as o
from . import views
from .queries_history import sql
from .queries_live import HIGH_SHARE, MEAN_DENSITY, MEAN_SCORE


def _landed(spark, sf_dir) -> str:
    """Scored events as JSON lines, as a producer leaves them."""
    path = scratch_path(spark, "events-json")
    tables.save_event_json(views.traffic(spark, sf_dir), path)
    return path


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def stream_to_table(spark, sf_dir) -> DataFrame:
    out = scratch_path(spark, "event-table")
    _finish(ingest.start_ingest(spark, _landed(spark, sf_dir), out, scratch_path(spark, "ckpt"), once=True))
    return spark.read.parquet(out).select(*EVENT_SCHEMA.names)


def stream_scoring(spark, sf_dir) -> DataFrame:
    """Raw events from a file stream, scored on the way."""
    source, out = scratch_path(spark, "raw-events"), scratch_path(spark, "scored")
    raw = views.raw_traffic(spark, sf_dir)
    raw.write.parquet(source)
    stream = spark.readStream.schema(raw.schema).parquet(source)
    _finish(ingest.start_table(scoring.score_events(stream), out, scratch_path(spark, "ckpt"), once=True))
    return spark.read.parquet(out).select(*EVENT_SCHEMA.names)


def trend_stream(spark, sf_dir) -> DataFrame:
    events = ingest.read_events(spark, _landed(spark, sf_dir))
    out = scratch_path(spark, "trend")
    trend = summaries.trend_stream(events)
    _finish(ingest.start_table(trend, out, scratch_path(spark, "ckpt"), once=True, partition_by=None))
    return spark.read.parquet(out)


def sliding_risk(spark, sf_dir) -> DataFrame:
    events = ingest.read_events(spark, _landed(spark, sf_dir))
    out = scratch_path(spark, "sliding")
    moving = summaries.sliding_risk(events, "15 minutes", "1 minute")
    _finish(ingest.start_table(moving, out, scratch_path(spark, "ckpt"), once=True, partition_by=None))
    return spark.read.parquet(out)


def alert_stream(spark, sf_dir) -> DataFrame:
    events = ingest.read_events(spark, _landed(spark, sf_dir))
    out = scratch_path(spark, "alerts")
    _finish(ingest.start_alerts(events, out, scratch_path(spark, "ckpt"), once=True))
    return spark.read.parquet(out).select("EventId", "Timestamp", "RiskLevel", "Confidence", "TrafficDensity")


def stats_stream(spark, sf_dir) -> DataFrame:
    events = ingest.read_events(spark, _landed(spark, sf_dir), max_files=4)
    out = scratch_path(spark, "stats")
    _finish(summaries.start_snapshots(summaries.stats_stream(events), out, scratch_path(spark, "ckpt"), once=True))
    return summaries.latest_snapshot(spark.read.parquet(out))


def weather_state(spark, sf_dir) -> DataFrame:
    """Current weather attached to every micro-batch, from observations read anew."""
    events = ingest.read_events(spark, _landed(spark, sf_dir))
    out = scratch_path(spark, "weathered")
    query = summaries.start_with_weather(
        events, lambda: views.weather_observations(spark, sf_dir), out, scratch_path(spark, "ckpt"), once=True
    )
    _finish(query)
    return spark.read.parquet(out).select("EventId", "obs_ts", "Weather")


# A bin is closed once the newest event is ten minutes past its end.
TREND_SQL = sql(f"""
SELECT time_bucket(INTERVAL 5 MINUTES, "Timestamp") AS "Timestamp", RoadName, {MEAN_DENSITY} AS AvgDensity,
       {MEAN_SCORE} AS AvgRiskScore, {HIGH_SHARE} AS HighRiskRate, count(*) FILTER (AlertTriggered) AS AlertCount
FROM traffic t GROUP BY 1, 2
HAVING time_bucket(INTERVAL 5 MINUTES, "Timestamp") + INTERVAL 5 MINUTES
       <= (SELECT max("Timestamp") FROM traffic) - INTERVAL 10 MINUTES""", o.TRAFFIC)

SLIDING_SQL = sql(f"""
, spans AS (
  SELECT t.*, time_bucket(INTERVAL 1 MINUTE, "Timestamp") + s.n * INTERVAL 1 MINUTE AS WindowEnd
  FROM traffic t, range(1, 16) s(n)
),
grouped AS (
  SELECT WindowEnd, LocationName, RoadName, Latitude, Longitude, count(*) AS EventCount, {MEAN_DENSITY} AS AvgDensity,
         {MEAN_SCORE} AS AvgRiskScore
  FROM spans WHERE WindowEnd <= (SELECT max("Timestamp") FROM traffic) - INTERVAL 10 MINUTES GROUP BY ALL
)
SELECT *, CASE WHEN AvgRiskScore >= 0.7 THEN 'High' WHEN AvgRiskScore >= 0.5 THEN 'Medium' ELSE 'Low' END AS RiskLevel,
       CASE WHEN AvgRiskScore >= 0.7 THEN 'red' WHEN AvgRiskScore >= 0.5 THEN 'orange' ELSE 'green' END AS RiskColor,
       CASE WHEN EventCount >= 10 THEN 'large' WHEN EventCount >= 5 THEN 'medium' ELSE 'small' END AS Size
FROM grouped""", o.TRAFFIC)

WEATHER_SQL = sql(f"""
, obs AS (SELECT ts AS obs_ts, k % 80 AS p FROM base WHERE event_type = 'view'),
found AS (
  SELECT r.EventId, o.p, CASE WHEN r."Timestamp" < o.obs_ts + INTERVAL 300 SECONDS THEN o.obs_ts END AS obs_ts
  FROM raw_traffic r ASOF LEFT JOIN obs o ON r."Timestamp" >= o.obs_ts
)
SELECT EventId, obs_ts,
       CASE WHEN obs_ts IS NOT NULL THEN
              CASE WHEN p > 50 THEN 'Heavy Rain' WHEN p > 5 THEN 'Rain' WHEN p > 0 THEN 'Light Rain' ELSE 'Clear' END
            WHEN {o.draw('EventId', ':weather')} < 0.7 THEN 'Clear'
            WHEN {o.draw('EventId', ':weather')} < 0.9 THEN 'Light Rain' ELSE 'Rain' END AS Weather
FROM found""", o.RAW_TRAFFIC)

QUERIES = {
    "stream_to_table": (stream_to_table, sql("SELECT * FROM traffic", o.TRAFFIC)),
    "stream_scoring": (stream_scoring, sql("SELECT * FROM traffic", o.TRAFFIC)),
    "trend_stream": (trend_stream, TREND_SQL),
    "sliding_risk": (sliding_risk, SLIDING_SQL),
    "alert_stream": (
        alert_stream,
        sql('SELECT EventId, "Timestamp", RiskLevel, Confidence, TrafficDensity FROM traffic WHERE AlertTriggered', o.TRAFFIC),
    ),
    "stats_stream": (
        stats_stream,
        sql("""SELECT count(*) AS events_generated, count(*) FILTER (RiskLevel = 'High') AS high_risk_events,
count(*) FILTER (AlertTriggered) AS alerts_triggered FROM traffic""", o.TRAFFIC),
    ),
    "weather_state": (weather_state, WEATHER_SQL),
}
