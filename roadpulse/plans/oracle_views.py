"""The derived tables of :mod:`.views` as SQL common table expressions."""

from __future__ import annotations

from ..functions import risk
from ..sources import dims
from . import views


def text_list(values) -> str:
    quoted = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"[{quoted}]"


def number_list(values) -> str:
    return "[" + ", ".join(f"{v!r}::DOUBLE" for v in values) + "]"


def case(column: str, mapping: dict, default: str) -> str:
    """CASE over a small mapping; text values are quoted, numbers are doubles."""

    def value(v) -> str:
        return "'" + v + "'" if isinstance(v, str) else f"{v!r}::DOUBLE"

    arms = " ".join(f"WHEN {column} = '{k}' THEN {value(v)}" for k, v in mapping.items())
    return f"CASE {arms} ELSE {default} END"


def rnd(expr: str, digits: int) -> str:
    """Half-up rounding through decimals, as a double."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,8)), {digits}) AS DOUBLE)"


def draw(key: str, salt: str) -> str:
    return f"(('0x' || substr(md5({key} || '{salt}'), 1, 8))::UBIGINT / 4294967296.0)"


def band(key: str, salt: str, lo: float, hi: float) -> str:
    return f"({lo!r}::DOUBLE + {draw(key, salt)} * {hi - lo!r}::DOUBLE)"


RAIN = "contains({}, 'Rain')"
LIVE_RUSH = "({0} BETWEEN 7 AND 9 OR {0} BETWEEN 17 AND 19)"

BASE = f"""
base AS (
  SELECT event_id, ts, user_id AS u, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INT) AS k,
         {text_list(views.ROAD_NAMES)}[user_id % 12 + 1] AS road_name,
         {text_list(views.ROAD_TYPES)}[user_id % 3 + 1] AS road_type,
         CAST(-145 + user_id % 31 AS DOUBLE) / 100.0::DOUBLE AS latitude,
         CAST(3665 + user_id % 46 AS DOUBLE) / 100.0::DOUBLE AS longitude,
         {case('event_type', views.WEATHER_OF_EVENT, 'NULL')} AS weather
  FROM events
)"""

TYPE_CASE = " ".join(
    f"WHEN road_type = '{kind}' THEN {text_list(mix)}[k % 6 + 1]" for kind, mix in dims.ACCIDENT_TYPES.items()
)
HIGH_RISK = "(lower(road_name) LIKE '%waiyaki way%' OR lower(road_name) LIKE '%thika%'" \
    " OR lower(road_name) LIKE '%mombasa road%' OR lower(road_name) LIKE '%uhuru highway%')"
IS_HIGHWAY = "(road_type = 'highway' OR lower(road_name) LIKE '%highway%')"
IS_STREET = "(road_type = 'city_street' OR lower(road_name) LIKE '%avenue%'" \
    " OR lower(road_name) LIKE '%kenyatta%' OR lower(road_name) LIKE '%moi%')"
CLASS_RISK = f"(CASE WHEN {IS_HIGHWAY} THEN 0.72::DOUBLE WHEN {IS_STREET} THEN 0.58::DOUBLE ELSE 0.65::DOUBLE END)"
BASE_RISK = f"least({CLASS_RISK} + CASE WHEN {HIGH_RISK} THEN 0.12::DOUBLE ELSE 0.0::DOUBLE END, 0.92::DOUBLE)"
LANES = f"CASE WHEN {IS_HIGHWAY} THEN 6 ELSE 4 END"
SPEED = f"CASE WHEN {IS_HIGHWAY} THEN 80 WHEN {IS_STREET} THEN 40 ELSE 60 END"

CAUSE = """
CASE WHEN coalesce(nullif(concat_ws(', ',
    CASE WHEN weather IN ('Rain', 'Heavy Rain') THEN 'Wet Road Surface' END,
    CASE WHEN weather = 'Fog' THEN 'Poor Visibility' END,
    CASE WHEN hour IN (7, 8, 17, 18, 19) THEN 'Heavy Traffic' END,
    CASE WHEN accident_type = 'Speeding' THEN 'Over-Speeding' END,
    CASE WHEN day_of_week = 'Friday' AND hour >= 17 THEN 'Rush Hour' END), ''), '') = '' THEN 'Driver Error'
ELSE concat_ws(', ',
    CASE WHEN weather IN ('Rain', 'Heavy Rain') THEN 'Wet Road Surface' END,
    CASE WHEN weather = 'Fog' THEN 'Poor Visibility' END,
    CASE WHEN hour IN (7, 8, 17, 18, 19) THEN 'Heavy Traffic' END,
    CASE WHEN accident_type = 'Speeding' THEN 'Over-Speeding' END,
    CASE WHEN day_of_week = 'Friday' AND hour >= 17 THEN 'Rush Hour' END) END"""

ACCIDENTS = f"""{BASE},
facts AS (
  SELECT *, event_id AS id, 'NRB' || CAST(event_id + 100000 AS VARCHAR) AS accident_id,
         road_name AS road_group,
         CASE WHEN event_id % 97 <> 0 THEN 'Loc-' || CAST(u AS VARCHAR) END AS location,
         {LANES} AS lanes, {SPEED} AS speed_limit, {BASE_RISK} AS base_risk,
         CASE WHEN k < 8 THEN 'Fatal' WHEN k < 38 THEN 'Serious' ELSE 'Minor' END AS severity,
         CASE {TYPE_CASE} END AS accident_type, k % 5 + 1 AS casualties,
         CASE WHEN k % 17 <> 0 THEN CAST(k % 11 + 16 AS DOUBLE) END AS temperature,
         {case('weather', views.PRECIPITATION, '0.0::DOUBLE')} AS precipitation,
         CAST(k AS DOUBLE) AS cloudcover, CAST(u % 11 + 5 AS DOUBLE) AS windspeed,
         CAST(10000 - 50 * k AS DOUBLE) AS visibility,
         CASE WHEN contains(weather, 'Rain') THEN 'Wet' ELSE 'Dry' END AS road_surface,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, strftime(ts, '%Y-%m-%d') AS date,
         strftime(ts, '%H:%M:%S') AS time, CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month,
         monthname(ts) AS month_name, CAST(day(ts) AS INT) AS day, CAST(hour(ts) AS INT) AS hour,
         dayname(ts) AS day_of_week
  FROM base
),
factored AS (
  SELECT *, day_of_week IN ('Saturday', 'Sunday') AS is_weekend,
         hour IN (7, 8, 17, 18, 19) AS is_rush_hour,
         list_contains({text_list(dims.HOLIDAYS)}, date) AS is_holiday,
         {number_list(dims.HOUR_FACTORS)}[hour + 1] AS time_risk_factor,
         {case('day_of_week', dims.DAY_FACTORS, '1.0::DOUBLE')} AS day_risk_factor,
         {case('weather', dims.WEATHER_FACTORS, '1.0::DOUBLE')} AS weather_risk_factor,
         CASE WHEN accident_type = 'Vehicle Collision' THEN 2 + k % 3
              WHEN accident_type = 'Pedestrian Knockdown' THEN 1 ELSE 1 + k % 2 END AS vehicles_involved
  FROM facts
),
scored AS (
  SELECT *, least(base_risk * time_risk_factor * day_risk_factor * weather_risk_factor
                  * CASE WHEN is_holiday THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END, 1.0::DOUBLE) AS raw
  FROM factored
),
dense AS (
  SELECT *, least(100, greatest(10, CAST(trunc(50.0::DOUBLE + raw * 40.0::DOUBLE + (k % 21 - 10)) AS INT))) AS traffic_density
  FROM scored
),
accidents AS (
  SELECT accident_id, timestamp, date, time, year, month, month_name, day, hour, day_of_week, is_weekend,
         is_rush_hour, is_holiday, road_name, road_group, location, latitude, longitude, road_type, lanes,
         speed_limit, weather, temperature, precipitation, cloudcover, windspeed, visibility, road_surface,
         severity, accident_type, casualties, vehicles_involved, {CAUSE} AS primary_cause, traffic_density,
         greatest(10, least(speed_limit + 10, CAST(trunc(speed_limit * (0.3::DOUBLE + 0.7::DOUBLE
             * (1.0::DOUBLE - traffic_density / 100.0::DOUBLE)) + (k % 21 - 10)) AS INT))) AS average_speed,
         {rnd('raw', 3)} AS risk_score,
         CASE WHEN raw >= 0.75 THEN 'High' WHEN raw >= 0.5 THEN 'Medium' ELSE 'Low' END AS risk_level,
         {rnd('base_risk', 3)} AS base_location_risk, time_risk_factor, weather_risk_factor, day_risk_factor, id
  FROM dense
)"""


def _confidence() -> str:
    arms = " ".join(
        f"WHEN level = '{name}' THEN {band('EventId', ':confidence', lo, hi)}"
        for name, (lo, hi) in risk.CONFIDENCE_BANDS.items()
    )
    return f"CASE {arms} END"


def _probability(which: str) -> str:
    """Drawn from its band, or what the two drawn ones of the level leave."""
    arms = []
    for level, bands in risk.PROBABILITY_BANDS.items():
        draws = {k: band("EventId", f":{k.lower()}", lo, hi) for k, (lo, hi) in bands.items()}
        rest = "1.0::DOUBLE - " + " - ".join(draws.values())
        arms.append(f"WHEN level = '{level}' THEN {draws.get(which, rest)}")
    return f"CASE {' '.join(arms)} END"


_FACTORS = f"""concat_ws(', ',
    CASE WHEN TrafficDensity >= 80 THEN 'High traffic density' END,
    CASE WHEN {RAIN.format('Weather')} THEN 'Adverse weather conditions' END,
    CASE WHEN {LIVE_RUSH.format('Hour')} THEN 'Rush hour traffic' END,
    CASE WHEN base_risk >= 0.7 THEN 'High-risk location' END)"""

RAW_TRAFFIC = f"""{BASE},
raw_traffic AS (
  SELECT 'P' || CAST(event_id AS VARCHAR) AS PredictionId, ts AS Timestamp, CAST(event_id AS VARCHAR) AS EventId,
         'Loc-' || CAST(u AS VARCHAR) AS LocationName, road_name AS RoadName, latitude AS Latitude,
         longitude AS Longitude, CAST(least(100, floor(value)) AS INT) AS TrafficDensity, weather AS Weather,
         CAST(30 + u % 14 * 5 AS DOUBLE) / 100.0::DOUBLE AS base_risk, CAST(hour(ts) AS INT) AS Hour
  FROM base
),
ruled AS (
  SELECT *, least(1.0::DOUBLE, TrafficDensity / 100.0::DOUBLE
              * CASE WHEN {RAIN.format('Weather')} THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END
              * CASE WHEN {LIVE_RUSH.format('Hour')} THEN 1.3::DOUBLE ELSE 1.0::DOUBLE END * base_risk) AS score
  FROM raw_traffic
),
levelled AS (
  SELECT *, CASE WHEN score >= 0.75 THEN 'High' WHEN score >= 0.45 THEN 'Medium' ELSE 'Low' END AS level FROM ruled
),
confident AS (SELECT *, {_confidence()} AS conf FROM levelled)"""

TRAFFIC = f"""{RAW_TRAFFIC},
traffic AS (
  SELECT PredictionId, Timestamp, EventId, LocationName, RoadName, Latitude, Longitude, level AS RiskLevel,
         {rnd('score', 4)} AS RiskScore, {rnd(_probability('High'), 4)} AS RiskProbabilityHigh,
         {rnd(_probability('Medium'), 4)} AS RiskProbabilityMedium,
         {rnd(_probability('Low'), 4)} AS RiskProbabilityLow, {rnd('conf', 4)} AS Confidence,
         CASE WHEN {_FACTORS} = '' THEN 'Normal traffic conditions' ELSE {_FACTORS} END AS PrimaryFactors,
         'Traffic density at ' || CAST(TrafficDensity AS VARCHAR) || '% with ' || lower(Weather)
           || ' conditions. Risk assessment based on traffic patterns and weather impact' AS AIExplanation,
         TrafficDensity, Weather, Hour,
         (level = 'High' AND conf > 0.8) OR TrafficDensity >= 90 AS AlertTriggered,
         CASE WHEN (level = 'High' AND conf > 0.8) OR TrafficDensity >= 90 THEN Timestamp END AS AlertSentTime
  FROM confident
)"""

POINTS = f"""{BASE},
points AS (
  SELECT event_id, road_name AS road_group, road_name,
         road_name || '_' || CAST(event_id AS VARCHAR) || '_' || CAST(u % 3 AS VARCHAR) AS segment_id,
         latitude, longitude, road_type, CAST(event_id AS VARCHAR) AS osm_id,
         CASE WHEN k % 2 = 0 THEN '50' END AS maxspeed,
         road_name || ' Segment ' || CAST(u % 3 AS VARCHAR) AS location
  FROM base
)"""

ROAD_DATABASE = f"""{POINTS},
road_database AS (SELECT *, {LANES} AS lanes, {SPEED} AS speed_limit, {BASE_RISK} AS base_risk FROM points)"""

EDGES = f"""{BASE},
edges AS (
  SELECT CASE WHEN k % 13 <> 0 THEN CASE WHEN k % 2 = 0 THEN upper(road_name) || ' East' ELSE road_name END END AS name,
         {text_list(views.EDGE_TAGS)}[u % 4 + 1] AS highway, CASE WHEN k % 2 = 0 THEN '50' END AS maxspeed,
         event_id, u, k % 3 AS key,
         CASE WHEN k % 19 <> 0 THEN k % 6 + 1 END AS n_points
  FROM base
)"""

WEATHER_DOCS = f"""{BASE},
hourly AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, hour(ts) AS hour, count(*) AS n, CAST(sum(k) AS BIGINT) AS s
  FROM base GROUP BY ALL
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY date ORDER BY hour) - 1 AS pos, count(*) OVER (PARTITION BY date) AS hours
  FROM hourly
),
midday AS (
  SELECT date, CAST(substr(date, 9, 2) AS INT) % 7 <> 0 AS has_hours,
         CASE WHEN n % 5 <> 0 THEN CAST(n % 12 + 16 AS DOUBLE) END AS t,
         CASE WHEN s % 3 = 0 THEN 0.0::DOUBLE ELSE s % 90 / 10.0::DOUBLE END AS p,
         CAST(s % 101 AS DOUBLE) AS c, s % 200 / 10.0::DOUBLE AS w, CAST(s * 7 % 12000 AS DOUBLE) AS v
  FROM numbered WHERE pos = least(12, hours - 1)
),
filled AS (
  SELECT date, has_hours,
         CASE WHEN t IS NULL OR t = 0 THEN 20.0::DOUBLE ELSE t END AS t, coalesce(p, 0.0::DOUBLE) AS p,
         coalesce(c, 0.0::DOUBLE) AS c, coalesce(w, 0.0::DOUBLE) AS w,
         CASE WHEN v IS NULL OR v = 0 THEN 10000.0::DOUBLE ELSE v END AS v
  FROM midday
),
weather_day AS (
  SELECT date,
         CASE WHEN has_hours THEN {rnd('t', 1)} ELSE 21.0::DOUBLE END AS temperature,
         CASE WHEN has_hours THEN {rnd('p', 1)} ELSE 0.0::DOUBLE END AS precipitation,
         CASE WHEN has_hours THEN {rnd('c', 0)} ELSE 20.0::DOUBLE END AS cloudcover,
         CASE WHEN has_hours THEN {rnd('w', 1)} ELSE 10.0::DOUBLE END AS windspeed,
         CASE WHEN has_hours THEN {rnd('v', 0)} ELSE 10000.0::DOUBLE END AS visibility,
         CASE WHEN NOT has_hours THEN 'Clear' WHEN p > 5 THEN 'Heavy Rain' WHEN p > 1 THEN 'Rain'
              WHEN p > 0 THEN 'Light Rain' WHEN c > 70 THEN 'Cloudy' WHEN v < 1000 THEN 'Fog' ELSE 'Clear' END AS weather,
         CASE WHEN has_hours AND p > 0 THEN 'Wet' ELSE 'Dry' END AS road_surface
  FROM filled
)"""

PREDICTIONS = f"""{ACCIDENTS},
{TRAFFIC[len(BASE) + 1:]},
predictions AS (
  SELECT a.id, a.risk_level AS label, t.RiskLevel AS prediction
  FROM accidents a JOIN traffic t ON a.id = CAST(t.EventId AS BIGINT)
)"""
