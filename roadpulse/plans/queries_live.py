"""Live scoring and dashboard queries with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dashboard as d
from ..functions import risk, text
from ..functions.calendar import ISO_FORMAT
from ..functions.numeric import rounded
from ..operators import dashboard, patterns, scoring
from ..schemas import EVENT_SCHEMA
from ..sources import tables
from . import oracle_views as o
from . import views
from .queries_history import PROFILE_SQL, _profile, sql


def event_scores(spark, sf_dir) -> DataFrame:
    return views.traffic(spark, sf_dir)


def rule_score(spark, sf_dir) -> DataFrame:
    decided = scoring.rule_columns(views.raw_traffic(spark, sf_dir).withColumn("Hour", F.hour("Timestamp")))
    return decided.select("EventId", rounded(F.col("score"), 4).alias("score"), "level")


def class_probs(spark, sf_dir) -> DataFrame:
    decided = scoring.rule_columns(views.raw_traffic(spark, sf_dir).withColumn("Hour", F.hour("Timestamp")))
    return decided.select(
        "EventId", *[rounded(F.col(f"probs.{c}"), 4).alias(c) for c in ("high", "medium", "low")],
        F.col("probs.invalid").alias("invalid"), rounded(F.col("conf"), 4).alias("confidence"),
    )


def expected_score(spark, sf_dir) -> DataFrame:
    events = views.traffic(spark, sf_dir)
    probs = F.array("RiskProbabilityHigh", "RiskProbabilityLow", "RiskProbabilityMedium")
    score = risk.expected_score(probs, ["High", "Low", "Medium"])
    return events.select("EventId", rounded(score, 4).alias("expected"))


def primary_factors(spark, sf_dir) -> DataFrame:
    return views.traffic(spark, sf_dir).select("EventId", "PrimaryFactors")


def explanation(spark, sf_dir) -> DataFrame:
    events = views.traffic(spark, sf_dir)
    ml = text.explanation("ML", F.col("RiskLevel"), F.col("Confidence"), F.col("TrafficDensity"), F.col("Weather"))
    return events.select("EventId", "AIExplanation", ml.alias("ml_explanation"))


def alert(spark, sf_dir) -> DataFrame:
    return dashboard.alerts(views.traffic(spark, sf_dir)).select("EventId", "AlertSentTime")


def serving_factors(spark, sf_dir) -> DataFrame:
    raw = views.raw_traffic(spark, sf_dir).withColumn("Hour", F.hour("Timestamp"))
    built = scoring.serving_features(raw)
    names = ("is_rush_hour", "is_weekend", "time_risk_factor", "weather_risk_factor", "day_risk_factor", "precipitation", "road_surface")
    return built.select("event.EventId", *names)


def serving_aligned(spark, sf_dir) -> DataFrame:
    raw = views.raw_traffic(spark, sf_dir).withColumn("Hour", F.hour("Timestamp"))
    built = scoring.serving_features(raw, "aligned")
    return built.select(
        "event.EventId", "latitude", "longitude", "time_risk_factor", "weather_risk_factor", "day_risk_factor"
    )


def watchlist_semi(spark, sf_dir) -> DataFrame:
    watched = patterns.watchlist(_profile(spark, sf_dir))
    events = views.traffic(spark, sf_dir)
    return patterns.on_watchlist(events, watched).select("EventId", "LocationName", "RoadName")


def recent_events(spark, sf_dir) -> DataFrame:
    events = views.traffic(spark, sf_dir)
    return dashboard.recent(events, "24 hours", dashboard.latest(events)).select("EventId", "Timestamp")


def dense_events(spark, sf_dir) -> DataFrame:
    return dashboard.dense(views.traffic(spark, sf_dir)).select("EventId", "TrafficDensity")


def heatmap(lookback: str):
    def run(spark, sf_dir) -> DataFrame:
        events = views.traffic(spark, sf_dir)
        return dashboard.risk_heatmap(events, dashboard.latest(events), lookback)

    return run


def heatmap_stats(spark, sf_dir) -> DataFrame:
    events = views.traffic(spark, sf_dir)
    return dashboard.heatmap_stats(events, dashboard.latest(events), "24 hours")


def active(lookback: str):
    def run(spark, sf_dir) -> DataFrame:
        events = views.traffic(spark, sf_dir)
        return dashboard.active_high_risk(events, dashboard.latest(events), lookback)

    return run


def trend(lookback: str):
    def run(spark, sf_dir) -> DataFrame:
        events = views.traffic(spark, sf_dir)
        return dashboard.risk_trend(events, dashboard.latest(events), lookback)

    return run


def impact(lookback: str):
    def run(spark, sf_dir) -> DataFrame:
        events = views.traffic(spark, sf_dir)
        return dashboard.weather_impact(events, dashboard.latest(events), lookback)

    return run


def feed(lookback: str):
    def run(spark, sf_dir) -> DataFrame:
        events = views.traffic(spark, sf_dir)
        return dashboard.live_feed(events, dashboard.latest(events), lookback)

    return run


def cell_colour(spark, sf_dir) -> DataFrame:
    events = views.traffic(spark, sf_dir)
    per_location = events.groupBy("LocationName").agg(F.count(F.lit(1)).alias("HighRiskCount"), F.max("TrafficDensity").alias("Density"))
    return dashboard.coloured_feed(dashboard.coloured_count(per_location))


def run_stats(spark, sf_dir) -> DataFrame:
    return dashboard.run_stats(views.traffic(spark, sf_dir))


def event_to_json(spark, sf_dir) -> DataFrame:
    """Events to JSON text and back; nulls must be written out."""
    lines = tables.to_event_json(views.traffic(spark, sf_dir))
    event = F.from_json("value", EVENT_SCHEMA, {"timestampFormat": ISO_FORMAT}).alias("e")
    return lines.select(event, F.col("value").contains('"AlertSentTime":null').alias("null_written")).select("e.*", "null_written")


def retention(spark, sf_dir) -> DataFrame:
    events = views.traffic(spark, sf_dir).withColumn("EventEnqueuedUtcTime", F.col("Timestamp"))
    kept = tables.apply_retention(events, dashboard.latest(events), days=1)
    return kept.select("EventId", "EventEnqueuedUtcTime")


def text_helpers(spark, sf_dir) -> DataFrame:
    """Text helpers on every event, null inputs included."""
    events = views.traffic(spark, sf_dir)
    sent = F.date_format("AlertSentTime", "HH:mm")
    return events.select(
        "EventId",
        d.strcat(F.col("LocationName"), "@", sent).alias("label"),
        d.tostring(F.col("RiskScore")).alias("score_text"),
        d.format_datetime(F.col("Timestamp")).alias("clock"),
        d.bin_start(F.col("Timestamp")).alias("bin"),
        d.display_level(F.col("RiskLevel")).alias("display"),
        d.alert_marker(F.col("AlertTriggered")).alias("marker"),
        d.risk_colour(F.col("RiskScore")).alias("colour"),
    )


def recent_sql(interval: str) -> str:
    return f"""
, recent AS (SELECT * FROM traffic WHERE "Timestamp" > (SELECT max("Timestamp") FROM traffic) - INTERVAL {interval})"""


MEAN_DENSITY = o.rnd("avg(TrafficDensity)", 1)
MEAN_SCORE = o.rnd("avg(RiskScore)", 3)
HIGH_SHARE = o.rnd("count(*) FILTER (RiskLevel = 'High') * 100.0::DOUBLE / count(*)", 1)
ALERT_SHARE = o.rnd("count(*) FILTER (AlertTriggered) * 100.0::DOUBLE / count(*)", 1)


def number_text(expr: str) -> str:
    return f"regexp_replace(CAST({expr} AS VARCHAR), '\\.0$', '')"


STATS = f"""
, stats AS (
  SELECT LocationName, RoadName, Latitude, Longitude, count(*) AS EventCount, {MEAN_DENSITY} AS AvgDensity,
         {MEAN_SCORE} AS AvgRiskScore, count(*) FILTER (RiskLevel = 'High') AS HighRiskCount, max("Timestamp") AS LatestAlert
  FROM recent GROUP BY ALL
),
mapped AS (
  SELECT *, CASE WHEN AvgRiskScore >= 0.7 THEN 'High' WHEN AvgRiskScore >= 0.5 THEN 'Medium' ELSE 'Low' END AS RiskLevel,
         CASE WHEN AvgRiskScore >= 0.7 THEN 'red' WHEN AvgRiskScore >= 0.5 THEN 'orange' ELSE 'green' END AS RiskColor,
         CASE WHEN EventCount >= 10 THEN 'large' WHEN EventCount >= 5 THEN 'medium' ELSE 'small' END AS Size
  FROM stats
)"""


def heatmap_sql(interval: str) -> str:
    return sql(f"""{recent_sql(interval)}{STATS}
SELECT Longitude, Latitude, LocationName || ' - ' || RoadName AS Title,
       'Density: ' || {number_text('AvgDensity')} || '%, Risk: ' || {number_text('AvgRiskScore')} || ', Events: '
         || CAST(EventCount AS VARCHAR) AS Description, RiskColor, Size FROM mapped""", o.TRAFFIC)


def active_sql(interval: str) -> str:
    return sql(f"{recent_sql(interval)} SELECT count(*) AS HighRiskCount FROM recent WHERE TrafficDensity >= 80", o.TRAFFIC)


def trend_sql(interval: str) -> str:
    return sql(f"""{recent_sql(interval)}
SELECT time_bucket(INTERVAL 5 MINUTES, "Timestamp") AS "Timestamp", RoadName, {MEAN_DENSITY} AS AvgDensity,
       {MEAN_SCORE} AS AvgRiskScore, {HIGH_SHARE} AS HighRiskRate, count(*) FILTER (AlertTriggered) AS AlertCount
FROM recent GROUP BY 1, 2""", o.TRAFFIC)


def impact_sql(interval: str) -> str:
    return sql(f"""{recent_sql(interval)}
SELECT Weather, count(*) AS EventCount, {MEAN_DENSITY} AS AvgDensity, {MEAN_SCORE} AS AvgRiskScore,
       {HIGH_SHARE} AS HighRiskPercentage, {ALERT_SHARE} AS AlertRate FROM recent GROUP BY Weather""", o.TRAFFIC)


def feed_sql(interval: str) -> str:
    return sql(f"""{recent_sql(interval)}
SELECT strftime("Timestamp", '%H:%M:%S') AS "Time", LocationName || ' (' || RoadName || ')' AS Location,
       TrafficDensity AS Density, Weather, RiskLevel, {o.rnd('RiskScore', 2)} AS RiskScore,
       {o.rnd('Confidence', 2)} AS Confidence, CASE WHEN AlertTriggered THEN '{d.ALERT_MARKER}' ELSE '' END AS Alert,
       CASE RiskLevel WHEN 'High' THEN 'HIGH' WHEN 'Medium' THEN 'MEDIUM' ELSE 'LOW' END AS RiskDisplay
FROM (SELECT * FROM recent ORDER BY "Timestamp" DESC, EventId LIMIT 20)""", o.TRAFFIC)


def rest_sql() -> str:
    """Whether the residual probability is negative, from the unrounded draws."""
    arms = []
    for level, bands in risk.PROBABILITY_BANDS.items():
        total = " + ".join(o.band("EventId", f":{k.lower()}", lo, hi) for k, (lo, hi) in bands.items())
        arms.append(f"WHEN level = '{level}' THEN {total} > 1.0::DOUBLE")
    return f"CASE {' '.join(arms)} END"


RUSH = o.LIVE_RUSH.format("Hour")

QUERIES = {
    "score_stream": (event_scores, sql("SELECT * FROM traffic", o.TRAFFIC)),
    "rule_score": (rule_score, sql(f"SELECT EventId, {o.rnd('score', 4)} AS score, level FROM levelled", o.RAW_TRAFFIC)),
    "class_probs": (
        class_probs,
        sql(f"""SELECT EventId, {o.rnd(o._probability('High'), 4)} AS high, {o.rnd(o._probability('Medium'), 4)} AS medium,
{o.rnd(o._probability('Low'), 4)} AS low, {rest_sql()} AS invalid, {o.rnd('conf', 4)} AS confidence FROM confident""", o.RAW_TRAFFIC),
    ),
    "expected_score": (
        expected_score,
        sql(f"""SELECT EventId, {o.rnd('0.9::DOUBLE * RiskProbabilityHigh + 0.3::DOUBLE * RiskProbabilityLow'
            ' + 0.6::DOUBLE * RiskProbabilityMedium', 4)} AS expected FROM traffic""", o.TRAFFIC),
    ),
    "primary_factors": (primary_factors, sql("SELECT EventId, PrimaryFactors FROM traffic", o.TRAFFIC)),
    "explanation": (
        explanation,
        sql("""SELECT EventId, AIExplanation, 'ML model prediction: ' || RiskLevel || ' risk with '
|| printf('%.0f', Confidence * 100) || '% confidence. Traffic density at ' || CAST(TrafficDensity AS VARCHAR) || '% with '
|| lower(Weather) || ' conditions' AS ml_explanation FROM traffic""", o.TRAFFIC),
    ),
    "alert": (alert, sql("SELECT EventId, AlertSentTime FROM traffic WHERE AlertTriggered", o.TRAFFIC)),
    "serving_features": (
        serving_factors,
        sql(f"""SELECT EventId, {RUSH} AS is_rush_hour, dayname("Timestamp") IN ('Saturday', 'Sunday') AS is_weekend,
CASE WHEN {RUSH} THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END AS time_risk_factor,
CASE WHEN contains(Weather, 'Rain') THEN 1.8::DOUBLE ELSE 1.0::DOUBLE END AS weather_risk_factor,
CASE WHEN dayname("Timestamp") IN ('Saturday', 'Sunday') THEN 0.7::DOUBLE ELSE 1.0::DOUBLE END AS day_risk_factor,
CASE WHEN contains(Weather, 'Rain') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS precipitation,
CASE WHEN contains(Weather, 'Rain') THEN 'Wet' ELSE 'Dry' END AS road_surface FROM raw_traffic""", o.RAW_TRAFFIC),
    ),
    "serving_features_aligned": (
        serving_aligned,
        sql(f"""SELECT EventId, Latitude AS latitude, Longitude AS longitude,
{o.number_list(views.dims.HOUR_FACTORS)}[Hour + 1] AS time_risk_factor,
{o.case('Weather', views.dims.WEATHER_FACTORS, '1.0::DOUBLE')} AS weather_risk_factor,
{o.case('dayname("Timestamp")', views.dims.DAY_FACTORS, '1.0::DOUBLE')} AS day_risk_factor FROM raw_traffic""", o.RAW_TRAFFIC),
    ),
    "watchlist_semi": (
        watchlist_semi,
        sql(f""", {o.TRAFFIC[len(o.BASE) + 2:]} {PROFILE_SQL},
watched AS (SELECT * FROM profile ORDER BY base_risk DESC, location_name, road_name LIMIT 12)
SELECT EventId, LocationName, RoadName FROM traffic t
WHERE EXISTS (SELECT 1 FROM watched w WHERE w.location_name = t.LocationName AND w.road_name = t.RoadName)"""),
    ),
    "recent": (recent_events, sql(f'{recent_sql("24 HOURS")} SELECT EventId, "Timestamp" FROM recent', o.TRAFFIC)),
    "dense_events": (dense_events, sql("SELECT EventId, TrafficDensity FROM traffic WHERE TrafficDensity >= 80", o.TRAFFIC)),
    "risk_heatmap": (heatmap("15 minutes"), heatmap_sql("15 MINUTES")),
    "risk_heatmap_24h": (heatmap("24 hours"), heatmap_sql("24 HOURS")),
    "heatmap_stats_24h": (heatmap_stats, sql(f'{recent_sql("24 HOURS")}{STATS} SELECT * FROM mapped', o.TRAFFIC)),
    "active_high_risk": (active("5 minutes"), active_sql("5 MINUTES")),
    "active_high_risk_24h": (active("24 hours"), active_sql("24 HOURS")),
    "risk_trend": (trend("1 hour"), trend_sql("1 HOUR")),
    "risk_trend_24h": (trend("24 hours"), trend_sql("24 HOURS")),
    "weather_impact": (impact("2 hours"), impact_sql("2 HOURS")),
    "weather_impact_24h": (impact("24 hours"), impact_sql("24 HOURS")),
    "live_feed": (feed("10 minutes"), feed_sql("10 MINUTES")),
    "live_feed_24h": (feed("24 hours"), feed_sql("24 HOURS")),
    "cell_colour": (
        cell_colour,
        sql("""SELECT LocationName, count(*) AS HighRiskCount, max(TrafficDensity) AS Density,
CASE WHEN count(*) > 10 THEN 'red' WHEN count(*) > 5 THEN 'yellow' END AS CountColour,
CASE WHEN max(TrafficDensity) >= 80 THEN 'red' WHEN max(TrafficDensity) BETWEEN 60 AND 79 THEN 'yellow' END AS DensityColour
FROM traffic GROUP BY LocationName""", o.TRAFFIC),
    ),
    "run_stats": (
        run_stats,
        sql(f"""SELECT count(*) AS events_generated, count(*) AS events_sent,
count(*) FILTER (RiskLevel = 'High') AS high_risk_events, count(*) FILTER (AlertTriggered) AS alerts_triggered,
{o.rnd('(epoch_us(max("Timestamp")) - epoch_us(min("Timestamp"))) / 60e6::DOUBLE', 1)} AS elapsed_minutes FROM traffic""", o.TRAFFIC),
    ),
    "event_to_json": (event_to_json, sql("SELECT *, AlertSentTime IS NULL AS null_written FROM traffic", o.TRAFFIC)),
    "retention": (
        retention, sql(f'{recent_sql("24 HOURS")} SELECT EventId, "Timestamp" AS "EventEnqueuedUtcTime" FROM recent', o.TRAFFIC),
    ),
    "text_helpers": (
        text_helpers,
        sql(f"""SELECT EventId, LocationName || '@' || coalesce(strftime(AlertSentTime, '%H:%M'), '') AS label,
{number_text('RiskScore')} AS score_text, strftime("Timestamp", '%H:%M:%S') AS clock,
time_bucket(INTERVAL 5 MINUTES, "Timestamp") AS bin,
CASE RiskLevel WHEN 'High' THEN 'HIGH' WHEN 'Medium' THEN 'MEDIUM' ELSE 'LOW' END AS display,
CASE WHEN AlertTriggered THEN '{d.ALERT_MARKER}' ELSE '' END AS marker,
CASE WHEN RiskScore >= 0.7 THEN 'red' WHEN RiskScore >= 0.5 THEN 'orange' ELSE 'green' END AS colour FROM traffic""", o.TRAFFIC),
    ),
}
