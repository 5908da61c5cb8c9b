"""Accident history and pattern queries with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar, numeric, risk, text
from ..functions.weather import weather_class_live
from ..operators import history, ordering, partials, patterns
from ..session import scratch_path
from ..sources import dims, tables, weather_docs
from . import oracle_views as o
from . import views

r6 = lambda c: numeric.rounded(F.col(c) if isinstance(c, str) else c, 6)


def sql(tail: str, views_sql: str = o.ACCIDENTS) -> str:
    return f"WITH {views_sql}\n{tail}"


CHECK_COLUMNS = ("id", "date", "time", "road_name", "location", "severity", "weather", "risk_score", "risk_level")


def scan_accidents(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "accidents")
    tables.save_parquet(views.accidents(spark, sf_dir), path)
    return tables.read_accidents(spark, path).select(*CHECK_COLUMNS)


def write_csv(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "accidents-csv")
    tables.save_csv(views.accidents(spark, sf_dir).select("id", *CHECK_COLUMNS[1:]), path)
    layout = "id bigint, date string, time string, road_name string, location string, severity string, " \
        "weather string, risk_score double, risk_level string"
    return spark.read.schema(layout).option("header", True).csv(path)


def location_patterns(spark, sf_dir) -> DataFrame:
    found = patterns.location_patterns(views.accidents(spark, sf_dir)).drop("UpdatedAt")
    return found.withColumn("AvgRiskScore", r6("AvgRiskScore"))


def location_patterns_strict(spark, sf_dir) -> DataFrame:
    found = patterns.location_patterns(views.accidents(spark, sf_dir), strict_30d=True).drop("UpdatedAt")
    return found.withColumn("AvgRiskScore", r6("AvgRiskScore"))


def _partials(spark, sf_dir) -> DataFrame:
    """The partial rows of all days, the last day's written once more."""
    rows = views.accidents(spark, sf_dir)
    path = scratch_path(spark, "partials")
    partials.write_partials(rows, path)
    last = rows.agg(F.max("date")).first()[0]
    if last:
        partials.update_days(rows, path, [last])
    return spark.read.parquet(path)


def location_patterns_by_day(spark, sf_dir) -> DataFrame:
    found = partials.patterns_of(_partials(spark, sf_dir)).drop("UpdatedAt")
    return found.withColumn("AvgRiskScore", r6("AvgRiskScore"))


def location_patterns_by_day_strict(spark, sf_dir) -> DataFrame:
    found = partials.patterns_of(_partials(spark, sf_dir), strict_30d=True).drop("UpdatedAt")
    return found.withColumn("AvgRiskScore", r6("AvgRiskScore"))


def _patterns_sql(where: str = "") -> str:
    return sql(f"""
, known AS (
  SELECT * FROM accidents WHERE location IS NOT NULL AND road_name IS NOT NULL
    AND latitude IS NOT NULL AND longitude IS NOT NULL {where}
),
hours AS (
  SELECT location, road_name, latitude, longitude, hour,
         row_number() OVER (PARTITION BY location, road_name, latitude, longitude ORDER BY count(*) DESC, hour) AS place
  FROM known GROUP BY location, road_name, latitude, longitude, hour
),
days AS (
  SELECT location, road_name, latitude, longitude, day_of_week,
         row_number() OVER (PARTITION BY location, road_name, latitude, longitude
                            ORDER BY count(*) DESC, day_of_week) AS place
  FROM known GROUP BY location, road_name, latitude, longitude, day_of_week
),
week AS (
  SELECT location, count(*) AS n FROM accidents
  WHERE date >= strftime((SELECT max(CAST(date AS DATE)) FROM accidents) - INTERVAL 7 DAYS, '%Y-%m-%d')
  GROUP BY location
),
groups AS (
  SELECT location, road_name, latitude, longitude, count(accident_id) AS n,
         count(*) FILTER (severity = 'Fatal') AS fatal, avg(risk_score) AS mean_risk, max(date) AS last_date
  FROM known GROUP BY ALL
)
SELECT g.location AS "LocationName", g.road_name AS "RoadName", g.latitude AS "Latitude", g.longitude AS "Longitude",
       coalesce(w.n, 0) AS "AccidentCount_7d", g.n AS "AccidentCount_30d", g.fatal AS "FatalCount_30d",
       {o.rnd('g.mean_risk', 6)} AS "AvgRiskScore", g.last_date AS "LastAccidentDate",
       coalesce(h.hour, 12) AS "PeakRiskHour", coalesce(d.day_of_week, 'Monday') AS "PeakRiskDay"
FROM groups g LEFT JOIN week w USING (location)
LEFT JOIN hours h ON h.location = g.location AND h.road_name = g.road_name AND h.latitude = g.latitude
  AND h.longitude = g.longitude AND h.place = 1
LEFT JOIN days d ON d.location = g.location AND d.road_name = g.road_name AND d.latitude = g.latitude
  AND d.longitude = g.longitude AND d.place = 1""")


MONTH_BACK = "AND date >= strftime((SELECT max(CAST(date AS DATE)) FROM accidents) - INTERVAL 30 DAYS, '%Y-%m-%d')"

PROFILE_SQL = f"""
, pairs AS (
  SELECT location, road_name, arg_min(latitude, id) FILTER (latitude IS NOT NULL) AS latitude,
         arg_min(longitude, id) FILTER (longitude IS NOT NULL) AS longitude,
         avg(CASE severity WHEN 'Fatal' THEN 1.0::DOUBLE WHEN 'Serious' THEN 0.7::DOUBLE
             WHEN 'Minor' THEN 0.3::DOUBLE ELSE 0.5::DOUBLE END) AS severity, avg(risk_score) AS risk
  FROM accidents WHERE location IS NOT NULL AND road_name IS NOT NULL GROUP BY location, road_name
),
per_location AS (SELECT location, count(*) AS n FROM accidents GROUP BY location),
counted AS (SELECT * FROM pairs JOIN per_location USING (location)),
profile AS (
  SELECT location AS location_name, road_name, latitude, longitude,
         {o.rnd('greatest(0.3::DOUBLE, least(0.95::DOUBLE, n / (SELECT max(n) FROM counted)::DOUBLE * 0.3::DOUBLE'
                ' + severity * 0.4::DOUBLE + risk * 0.3::DOUBLE))', 6)} AS base_risk
  FROM counted
)"""


def _profile(spark, sf_dir) -> DataFrame:
    profile = patterns.location_profile(views.accidents(spark, sf_dir))
    return profile.withColumn("base_risk", r6("base_risk"))


def location_profile_by_day(spark, sf_dir) -> DataFrame:
    return partials.profile_of(_partials(spark, sf_dir)).withColumn("base_risk", r6("base_risk"))


def watchlist(spark, sf_dir) -> DataFrame:
    return patterns.watchlist(_profile(spark, sf_dir))


def profile(spark, sf_dir) -> DataFrame:
    flags = {
        "highways": F.col("road_type") == "highway",
        "main_roads": F.col("road_type") == "main_road",
        "city_streets": F.col("road_type") == "city_street",
    }
    return history.profile(views.accidents(spark, sf_dir), flags=flags)


def sequence_id(spark, sf_dir) -> DataFrame:
    rows = views.accidents(spark, sf_dir).select("accident_id", "timestamp")
    return ordering.with_sequence(rows, ["timestamp", "accident_id"], "id")


def chrono_sort(spark, sf_dir) -> DataFrame:
    rows = views.accidents(spark, sf_dir).select("id", "timestamp", "severity")
    return ordering.chrono(rows, "timestamp", "id")


def head(spark, sf_dir) -> DataFrame:
    rows = views.accidents(spark, sf_dir).select(*CHECK_COLUMNS)
    return ordering.top_n(rows, ["date", "time", "id"], 10)


def calendar_parts(spark, sf_dir) -> DataFrame:
    parts = history.with_calendar(views.base_events(spark, sf_dir).select("event_id", "ts"))
    return parts.drop("ts")


def cyclical(spark, sf_dir) -> DataFrame:
    rows = views.accidents(spark, sf_dir)
    hour_sin, hour_cos = calendar.cyclical(F.col("hour"), 24)
    month_sin, month_cos = calendar.cyclical(F.col("month"), 12)
    return rows.select(
        "id", r6(hour_sin).alias("hour_sin"), r6(hour_cos).alias("hour_cos"),
        r6(month_sin).alias("month_sin"), r6(month_cos).alias("month_cos"),
    )


def risk_factor_join(spark, sf_dir) -> DataFrame:
    timed = history.with_calendar(views.base_events(spark, sf_dir).select("event_id", "ts", "weather"))
    return history.with_risk_factors(timed, history.factor_tables(spark)).select(
        "event_id", "hour", "day_of_week", "weather", "time_risk_factor", "day_risk_factor", "weather_risk_factor"
    )


def holiday_flag(spark, sf_dir) -> DataFrame:
    dated = views.base_events(spark, sf_dir).select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("date"))
    return history.with_holiday(dated, dims.holidays(spark))


def weather_ingest(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "weather-docs")
    views.weather_docs(spark, sf_dir).write.json(path)
    return weather_docs.read_weather_docs(spark, path)


def weather_by_date(spark, sf_dir) -> DataFrame:
    docs = views.weather_docs(spark, sf_dir)
    dated = views.base_events(spark, sf_dir).select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("date"))
    return history.with_weather(dated, weather_docs.weather_days(docs))


def weather_asof(spark, sf_dir) -> DataFrame:
    events = views.raw_traffic(spark, sf_dir).select("EventId", "Timestamp")
    return history.weather_asof(events, views.weather_observations(spark, sf_dir))


def weather_asof_ordered(spark, sf_dir) -> DataFrame:
    events = views.raw_traffic(spark, sf_dir).select("EventId", "Timestamp")
    return history.weather_asof_ordered(events, views.weather_observations(spark, sf_dir))


ASOF_SQL = sql(f"""
, obs AS (SELECT ts AS obs_ts, CAST(k % 80 AS DOUBLE) / 10.0::DOUBLE AS precipitation, CAST(k % 11 + 16 AS DOUBLE) AS temperature
          FROM base WHERE event_type = 'view'),
found AS (
  SELECT r."EventId", r."Timestamp", o.obs_ts, o.precipitation, o.temperature
  FROM raw_traffic r ASOF LEFT JOIN obs o ON r."Timestamp" >= o.obs_ts
)
SELECT "EventId", "Timestamp",
       CASE WHEN "Timestamp" < obs_ts + INTERVAL 300 SECONDS THEN obs_ts END AS obs_ts,
       CASE WHEN "Timestamp" < obs_ts + INTERVAL 300 SECONDS THEN precipitation END AS precipitation,
       CASE WHEN "Timestamp" < obs_ts + INTERVAL 300 SECONDS THEN temperature END AS temperature
FROM found""", o.RAW_TRAFFIC)


def weather_classes(spark, sf_dir) -> DataFrame:
    seen = views.base_events(spark, sf_dir)
    return seen.select(F.col("ts").alias("obs_ts"), weather_class_live(F.col("k") % 80 / 10.0).alias("weather"))


def risk_score_hist(spark, sf_dir) -> DataFrame:
    return views.accidents(spark, sf_dir).select("id", "risk_score", "base_location_risk", "risk_level")


def risk_level(spark, sf_dir) -> DataFrame:
    rows = views.accidents(spark, sf_dir)
    score = F.col("risk_score")
    return rows.select(
        "id",
        risk.risk_level(score, *risk.HISTORY_LEVELS).alias("history"),
        risk.risk_level(score, *risk.LIVE_LEVELS).alias("live"),
        risk.risk_level(score, *risk.MAP_LEVELS).alias("map"),
    )


def accident_probability(spark, sf_dir) -> DataFrame:
    return views.accidents(spark, sf_dir).select(
        "id", r6(risk.accident_probability(F.col("risk_score"))).alias("probability")
    )


def severity_weights(spark, sf_dir) -> DataFrame:
    mixed = history.severity_mix(views.accidents(spark, sf_dir).select("id", "risk_score"))
    return mixed.select("id", *[r6(c).alias(c) for c in ("p_fatal", "p_serious", "p_minor")])


def accident_type_mix(spark, sf_dir) -> DataFrame:
    mix = history.accident_type_mix(views.accidents(spark, sf_dir))
    return mix.withColumn("expected", r6("expected"))


def _mix_sql() -> str:
    rows = ", ".join(
        f"('{road}', '{kind}', {share}::DOUBLE)" for road, mix in dims.ACCIDENT_TYPES.items() for kind, share in mix.items()
    )
    return sql(f"""
, mix(road_type, accident_type, share) AS (VALUES {rows})
SELECT a.road_name, m.accident_type, {o.rnd('sum(m.share)', 6)} AS expected
FROM accidents a JOIN mix m USING (road_type) GROUP BY a.road_name, m.accident_type""")


def season_defaults(spark, sf_dir) -> DataFrame:
    expected = history.expected_weather(views.accidents(spark, sf_dir))
    return expected.withColumn("expected", r6("expected"))


def _season_sql() -> str:
    rows = ", ".join(
        f"({month}, '{dims.season(month)}', '{label}', {share}::DOUBLE)"
        for month in range(1, 13) for label, share in dims.SEASON_WEATHER[dims.season(month)].items()
    )
    return sql(f"""
, shares(month, season, weather, share) AS (VALUES {rows})
SELECT month, season, s.weather, {o.rnd('count(*) * max(share)', 6)} AS expected
FROM accidents a JOIN shares s USING (month) GROUP BY month, season, s.weather""")


def density_estimate(spark, sf_dir) -> DataFrame:
    rows = views.accidents(spark, sf_dir)
    return rows.select("id", risk.density_estimate(F.col("risk_score")).alias("density"))


def speed_estimate(spark, sf_dir) -> DataFrame:
    rows = views.accidents(spark, sf_dir)
    return rows.select("id", risk.speed_estimate(F.col("speed_limit"), F.col("traffic_density")).alias("speed"))


def primary_cause(spark, sf_dir) -> DataFrame:
    rows = views.accidents(spark, sf_dir)
    cause = text.primary_cause(F.col("weather"), F.col("hour"), F.col("accident_type"), F.col("day_of_week"))
    return rows.select("id", cause.alias("cause"))


def severity_score(spark, sf_dir) -> DataFrame:
    rows = views.accidents(spark, sf_dir)
    return rows.select("id", risk.severity_score(F.col("severity")).alias("severity_score"))


def iso_time(spark, sf_dir) -> DataFrame:
    rows = views.base_events(spark, sf_dir)
    iso = calendar.format_iso(F.col("ts"))
    return rows.select("event_id", iso.alias("iso"), calendar.parse_iso(iso).alias("parsed"))


def portable_uniform(spark, sf_dir) -> DataFrame:
    rows = views.base_events(spark, sf_dir)
    return rows.select("event_id", numeric.rounded(numeric.uniform01(F.col("event_id"), ":draw"), 8).alias("u"))


def enrich_accidents(spark, sf_dir) -> DataFrame:
    """Facts, roads and weather joined to the full accident table."""
    base = views.base_events(spark, sf_dir).withColumn("location", F.concat(F.lit("Loc-"), F.col("u").cast("string")))
    facts = base.select(
        F.concat(F.lit("NRB"), F.col("event_id").cast("string")).alias("accident_id"),
        F.col("event_id").alias("id"), "ts", "location", "road_name", "severity",
        F.when(F.col("k") % 9 == 0, "Speeding").otherwise("Other").alias("accident_type"),
        (F.col("k") % 5 + 1).alias("casualties"), F.lit(1).alias("vehicles_involved"),
    )
    from ..operators import roads

    points = base.select(
        F.col("road_name").alias("road_group"), "road_name", "location", "latitude", "longitude", "road_type"
    ).distinct()
    database = roads.calibrate(roads.build_road_database(points), dims.hotspots(spark))
    weather = weather_docs.weather_days(views.weather_docs(spark, sf_dir))
    full = history.enrich_accidents(facts, database, weather)
    return full.select(
        "id", "date", "hour", "location", "road_name", "lanes", "speed_limit", "weather", "temperature",
        "risk_score", "risk_level", "base_location_risk", "traffic_density", "average_speed", "primary_cause",
    )


CALIBRATED = """least(0.95::DOUBLE, base_risk * CASE
    WHEN lower(road_name) LIKE '%thika%' OR lower(road_name) LIKE '%a2%' THEN 1.25::DOUBLE
    WHEN lower(road_name) LIKE '%uca%' THEN 1.35::DOUBLE
    WHEN lower(road_name) LIKE '%mombasa%' OR lower(road_name) LIKE '%a8%' OR lower(road_name) LIKE '%a109%' THEN 1.2::DOUBLE
    WHEN lower(road_name) LIKE '%ucb%' THEN 1.22::DOUBLE ELSE 1.0::DOUBLE END)"""

ENRICH_SQL = f"""WITH {o.WEATHER_DOCS},
facts AS (
  SELECT event_id AS id, ts, 'Loc-' || CAST(u AS VARCHAR) AS location, road_name, road_type,
         CASE WHEN k % 9 = 0 THEN 'Speeding' ELSE 'Other' END AS accident_type,
         strftime(ts, '%Y-%m-%d') AS date, CAST(hour(ts) AS INT) AS hour, dayname(ts) AS day_of_week,
         {o.LANES} AS lanes, {o.SPEED} AS speed_limit, {o.BASE_RISK} AS base_risk
  FROM base
),
factored AS (
  SELECT f.*, w.weather, w.temperature, {CALIBRATED} AS place_risk,
         {o.number_list(dims.HOUR_FACTORS)}[hour + 1] AS tf, {o.case('day_of_week', dims.DAY_FACTORS, '1.0::DOUBLE')} AS df,
         {o.case('w.weather', dims.WEATHER_FACTORS, '1.0::DOUBLE')} AS wf,
         CASE WHEN list_contains({o.text_list(dims.HOLIDAYS)}, date) THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END AS hf
  FROM facts f JOIN weather_day w USING (date)
),
scored AS (SELECT *, least(place_risk * tf * df * wf * hf, 1.0::DOUBLE) AS raw FROM factored),
dense AS (SELECT *, least(100, greatest(10, CAST(trunc(50.0::DOUBLE + raw * 40.0::DOUBLE) AS INT))) AS traffic_density FROM scored)
SELECT id, date, hour, location, road_name, lanes, speed_limit, weather, temperature, {o.rnd('raw', 3)} AS risk_score,
       CASE WHEN raw >= 0.75 THEN 'High' WHEN raw >= 0.5 THEN 'Medium' ELSE 'Low' END AS risk_level,
       {o.rnd('place_risk', 3)} AS base_location_risk, traffic_density,
       greatest(10, least(speed_limit + 10, CAST(trunc(speed_limit * (0.3::DOUBLE + 0.7::DOUBLE
           * (1.0::DOUBLE - traffic_density / 100.0::DOUBLE))) AS INT))) AS average_speed, {o.CAUSE} AS primary_cause
FROM dense"""

DENSITY_SQL = "least(100, greatest(10, CAST(trunc(50.0::DOUBLE + risk_score * 40.0::DOUBLE) AS INT)))"
SPEED_SQL = "greatest(10, least(speed_limit + 10, CAST(trunc(speed_limit * (0.3::DOUBLE + 0.7::DOUBLE" \
    " * (1.0::DOUBLE - traffic_density / 100.0::DOUBLE))) AS INT)))"
COLUMNS_SQL = ", ".join(CHECK_COLUMNS)


def _level_sql(hi: float, mid: float) -> str:
    return f"CASE WHEN risk_score >= {hi} THEN 'High' WHEN risk_score >= {mid} THEN 'Medium' ELSE 'Low' END"


WEIGHTS_SQL = """SELECT id, greatest(0.03::DOUBLE, risk_score * 0.08::DOUBLE) AS f,
    greatest(0.15::DOUBLE, risk_score * 0.3::DOUBLE) AS s,
    1.0::DOUBLE - greatest(0.18::DOUBLE, risk_score * 0.38::DOUBLE) AS m FROM accidents"""

QUERIES = {
    "scan_accidents": (scan_accidents, sql(f"SELECT {COLUMNS_SQL} FROM accidents")),
    "write_csv": (write_csv, sql(f"SELECT {COLUMNS_SQL} FROM accidents")),
    "location_patterns": (location_patterns, _patterns_sql()),
    "location_patterns_strict": (location_patterns_strict, _patterns_sql(MONTH_BACK)),
    "location_patterns_by_day": (location_patterns_by_day, _patterns_sql()),
    "location_patterns_by_day_strict": (location_patterns_by_day_strict, _patterns_sql(MONTH_BACK)),
    "recent_counts": (
        lambda s, d: patterns.recent_counts(views.accidents(s, d), 7),
        sql("""SELECT location, count(*) AS "AccidentCount_7d" FROM accidents
WHERE date >= strftime((SELECT max(CAST(date AS DATE)) FROM accidents) - INTERVAL 7 DAYS, '%Y-%m-%d') AND location IS NOT NULL GROUP BY location"""),
    ),
    "location_profile": (_profile, sql(f"{PROFILE_SQL} SELECT * FROM profile")),
    "location_profile_by_day": (location_profile_by_day, sql(f"{PROFILE_SQL} SELECT * FROM profile")),
    "watchlist": (
        watchlist, sql(f"{PROFILE_SQL} SELECT * FROM profile ORDER BY base_risk DESC, location_name, road_name LIMIT 12"),
    ),
    "value_counts": (
        lambda s, d: patterns.value_counts(views.accidents(s, d), "severity"),
        sql("SELECT severity, count(*) AS count FROM accidents GROUP BY severity"),
    ),
    "profile": (
        profile,
        sql("""SELECT count(*) AS row_count, 42 AS column_count, count(DISTINCT road_name) AS road_count,
min(date) AS first_date, max(date) AS last_date,
date_diff('day', CAST(min(date) AS DATE), CAST(max(date) AS DATE)) + 1 AS days_covered,
count(*) FILTER (road_type = 'highway') AS highways, count(*) FILTER (road_type = 'main_road') AS main_roads,
count(*) FILTER (road_type = 'city_street') AS city_streets FROM accidents"""),
    ),
    "sequence_id": (
        sequence_id,
        sql("SELECT accident_id, timestamp, row_number() OVER (ORDER BY timestamp, accident_id) AS id FROM accidents"),
    ),
    "chrono_sort": (chrono_sort, sql("SELECT id, timestamp, severity FROM accidents ORDER BY timestamp, id")),
    "head": (head, sql(f"SELECT {COLUMNS_SQL} FROM accidents ORDER BY date, time, id LIMIT 10")),
    "calendar_parts": (
        calendar_parts,
        sql("""SELECT id AS event_id, timestamp, date, time, year, month, month_name, day, hour, day_of_week,
is_weekend, is_rush_hour FROM accidents"""),
    ),
    "cyclical": (
        cyclical,
        sql(f"""SELECT id, {o.rnd('sin(hour * 2 * pi() / 24)', 6)} AS hour_sin, {o.rnd('cos(hour * 2 * pi() / 24)', 6)} AS hour_cos,
{o.rnd('sin(month * 2 * pi() / 12)', 6)} AS month_sin, {o.rnd('cos(month * 2 * pi() / 12)', 6)} AS month_cos FROM accidents"""),
    ),
    "risk_factor_join": (
        risk_factor_join,
        sql("""SELECT id AS event_id, hour, day_of_week, weather, time_risk_factor, day_risk_factor, weather_risk_factor
FROM accidents"""),
    ),
    "holiday_flag": (holiday_flag, sql("SELECT id AS event_id, date, is_holiday FROM accidents")),
    "weather_ingest": (weather_ingest, sql("SELECT * FROM weather_day", o.WEATHER_DOCS)),
    "weather_by_date": (
        weather_by_date,
        sql("""
, dated AS (SELECT event_id, strftime(ts, '%Y-%m-%d') AS date FROM base)
SELECT event_id, date, coalesce(temperature, 21.0::DOUBLE) AS temperature, coalesce(precipitation, 0.0::DOUBLE) AS precipitation,
       coalesce(cloudcover, 20.0::DOUBLE) AS cloudcover, coalesce(windspeed, 10.0::DOUBLE) AS windspeed,
       coalesce(visibility, 10000.0::DOUBLE) AS visibility, coalesce(weather, 'Clear') AS weather,
       coalesce(road_surface, 'Dry') AS road_surface
FROM dated LEFT JOIN weather_day USING (date)""", o.WEATHER_DOCS),
    ),
    "weather_asof": (weather_asof, ASOF_SQL),
    "weather_asof_ordered": (weather_asof_ordered, ASOF_SQL),
    "weather_class_live": (
        weather_classes,
        sql("""SELECT ts AS obs_ts, CASE WHEN k % 80 > 50 THEN 'Heavy Rain' WHEN k % 80 > 5 THEN 'Rain'
WHEN k % 80 > 0 THEN 'Light Rain' ELSE 'Clear' END AS weather FROM base""", o.BASE),
    ),
    "risk_score_hist": (risk_score_hist, sql("SELECT id, risk_score, base_location_risk, risk_level FROM accidents")),
    "risk_level": (
        risk_level,
        sql(f"""SELECT id, {_level_sql(0.75, 0.5)} AS history, {_level_sql(0.75, 0.45)} AS live,
{_level_sql(0.7, 0.5)} AS map FROM accidents"""),
    ),
    "accident_probability": (
        accident_probability, sql(f"SELECT id, {o.rnd('risk_score * 0.15::DOUBLE', 6)} AS probability FROM accidents"),
    ),
    "severity_weights": (
        severity_weights,
        sql(f"""SELECT id, {o.rnd('f / (f + s + m)', 6)} AS p_fatal, {o.rnd('s / (f + s + m)', 6)} AS p_serious,
{o.rnd('m / (f + s + m)', 6)} AS p_minor FROM ({WEIGHTS_SQL})"""),
    ),
    "accident_type_mix": (accident_type_mix, _mix_sql()),
    "season_defaults": (season_defaults, _season_sql()),
    "density_estimate": (density_estimate, sql(f"SELECT id, {DENSITY_SQL} AS density FROM accidents")),
    "speed_estimate": (speed_estimate, sql(f"SELECT id, {SPEED_SQL} AS speed FROM accidents")),
    "primary_cause": (primary_cause, sql(f"SELECT id, {o.CAUSE} AS cause FROM accidents")),
    "severity_score": (
        severity_score,
        sql("""SELECT id, CASE severity WHEN 'Fatal' THEN 1.0::DOUBLE WHEN 'Serious' THEN 0.7::DOUBLE
WHEN 'Minor' THEN 0.3::DOUBLE ELSE 0.5::DOUBLE END AS severity_score FROM accidents"""),
    ),
    "iso_time": (
        iso_time,
        sql("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso, ts AS parsed FROM base", o.BASE),
    ),
    "portable_uniform": (
        portable_uniform,
        sql(f"SELECT event_id, {o.rnd(o.draw('CAST(event_id AS VARCHAR)', ':draw'), 8)} AS u FROM base", o.BASE),
    ),
    "enrich_accidents": (enrich_accidents, ENRICH_SQL),
}
