"""Road queries with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import roads as road_functions
from ..functions.numeric import rounded
from ..operators import ordering, patterns, roads
from ..sources import dims, tables
from ..session import scratch_path
from . import oracle_views as o
from . import views
from .queries_history import CALIBRATED, r6, sql


def road_edges_scan(spark, sf_dir) -> DataFrame:
    """Edges written to parquet and read back with the declared schema, one row per edge."""
    path = scratch_path(spark, "edges")
    tables.save_parquet(views.road_edges(spark, sf_dir), path)
    edges = tables.read_edges(spark, path)
    return edges.select(
        F.col("edge_key.u").alias("edge"), "name", "highway", "maxspeed", F.size("geometry").alias("points")
    )


def road_name_match(spark, sf_dir) -> DataFrame:
    return roads.match_road(views.event_points(spark, sf_dir), "uca2").select("event_id", "road_name")


def high_risk_road(spark, sf_dir) -> DataFrame:
    points = views.event_points(spark, sf_dir)
    return points.select("event_id", road_functions.is_high_risk_road(F.col("road_name")).alias("high_risk"))


def bbox(spark, sf_dir) -> DataFrame:
    # Northern half of the box, so that points lie on, inside and outside of it.
    box = {"latitude": (-1.30, -1.15), "longitude": (36.65, 36.95)}
    return roads.in_bbox(views.event_points(spark, sf_dir), box).select("event_id", "latitude", "longitude")


def dedup_points(spark, sf_dir) -> DataFrame:
    first = ordering.dedup_first(views.event_points(spark, sf_dir), ["latitude", "longitude"], ["event_id"])
    return first.select("event_id", "road_name", "segment_id", "latitude", "longitude")


def line_points(spark, sf_dir) -> DataFrame:
    edges = views.road_edges(spark, sf_dir).filter(F.size("geometry") > 0)
    points = edges.select(
        F.col("edge_key.u").alias("edge"), F.posexplode(road_functions.line_points(F.col("geometry"))).alias("point", "xy")
    )
    return points.select("edge", "point", F.col("xy.lon").alias("longitude"), F.col("xy.lat").alias("latitude"))


POINTS_SQL = """
, spots AS (
  SELECT e.*, s.point, CASE s.point WHEN 0 THEN 0 WHEN 1 THEN n_points // 2 ELSE n_points - 1 END AS i
  FROM edges e, (VALUES (0), (1), (2)) s(point) WHERE n_points IS NOT NULL
),
drawn AS (
  SELECT *, CAST(3660 + (u + i) % 56 AS DOUBLE) / 100.0::DOUBLE AS longitude,
         CAST(-148 + (u + i) % 37 AS DOUBLE) / 100.0::DOUBLE AS latitude
  FROM spots
)"""


def road_type(spark, sf_dir) -> DataFrame:
    edges = views.road_edges(spark, sf_dir)
    return edges.select(F.col("edge_key.u").alias("edge"), road_functions.road_type(F.col("highway")).alias("road_type"))


ROAD_TYPE_SQL = """CASE WHEN contains(lower(highway), 'highway') THEN 'highway'
WHEN contains(highway, 'primary') THEN 'main_road' ELSE 'city_street' END"""


def alias_first_match(spark, sf_dir) -> DataFrame:
    found = roads.match_aliases(views.road_edges(spark, sf_dir))
    return found.select(F.col("edge_key.u").alias("edge"), "road_group", "road_name")


def _alias_rows() -> str:
    rows = []
    for g, (group, names) in enumerate(dims.ROAD_ALIASES.items()):
        for a, alias in enumerate(names):
            rows.append("({}, {}, '{}', '{}')".format(g, a, group.replace("'", "''"), alias.replace("'", "''")))
    return ", ".join(rows)


ALIAS_SQL = f"""
, aliases(g, a, road_group, road_name) AS (VALUES {_alias_rows()}),
hits AS (SELECT * FROM edges e JOIN aliases x ON contains(lower(e.name), lower(x.road_name))),
winners AS (SELECT g, min(a) AS a FROM hits GROUP BY g),
matched AS (SELECT h.* FROM hits h JOIN winners w ON h.g = w.g AND h.a = w.a)"""


def extract_road_points(spark, sf_dir) -> DataFrame:
    points = roads.extract_road_points(views.road_edges(spark, sf_dir))
    return points.select("road_group", "road_name", "segment_id", "latitude", "longitude", "road_type", "osm_id", "location")


EXTRACT_SQL = f"""
, keyed AS (SELECT *, '(' || event_id || ', ' || u || ', ' || key || ')' AS edge_text FROM matched),
sampled AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY road_group ORDER BY {o.draw('edge_text', ':42')}, edge_text) AS n FROM keyed
  ) WHERE n <= 15
),
spots AS (
  SELECT e.*, s.point, CASE s.point WHEN 0 THEN 0 WHEN 1 THEN n_points // 2 ELSE n_points - 1 END AS i
  FROM sampled e, (VALUES (0), (1), (2)) s(point) WHERE n_points IS NOT NULL
),
drawn AS (
  SELECT *, CAST(3660 + (u + i) % 56 AS DOUBLE) / 100.0::DOUBLE AS longitude,
         CAST(-148 + (u + i) % 37 AS DOUBLE) / 100.0::DOUBLE AS latitude,
         road_group || '_' || edge_text || '_' || point AS segment_id
  FROM spots
),
firsts AS (SELECT *, row_number() OVER (PARTITION BY latitude, longitude ORDER BY g, segment_id) AS place FROM drawn)
SELECT road_group, road_name, segment_id, latitude, longitude, {ROAD_TYPE_SQL} AS road_type,
       CAST(key AS VARCHAR) AS osm_id, road_name || ' Segment ' || point AS location
FROM firsts WHERE place = 1 AND latitude BETWEEN -1.45 AND -1.15 AND longitude BETWEEN 36.65 AND 37.1"""


def sample_per_group(spark, sf_dir) -> DataFrame:
    points = views.event_points(spark, sf_dir)
    kept = ordering.sample_n(points, "road_name", 15, F.col("event_id"))
    return kept.select("event_id", "road_name")


def road_class(spark, sf_dir) -> DataFrame:
    database = views.road_database(spark, sf_dir)
    return database.select("event_id", "lanes", "speed_limit", rounded(F.col("base_risk"), 6).alias("base_risk"))


def base_risk_adjust(spark, sf_dir) -> DataFrame:
    points = views.event_points(spark, sf_dir)
    raised = road_functions.adjust_base_risk(views.choose((0.72, 0.58, 0.65, 0.85), F.col("event_id") % 4), F.col("road_name"))
    return points.select("event_id", rounded(raised, 6).alias("base_risk"))


def calibrated(spark, sf_dir) -> DataFrame:
    database = views.road_database(spark, sf_dir)
    return roads.calibrate(database, dims.hotspots(spark)).withColumn("base_risk", r6("base_risk"))


def calibrate(spark, sf_dir) -> DataFrame:
    return calibrated(spark, sf_dir).select("event_id", "road_name", "base_risk", "ntsa_verified", "ntsa_fatal_rate")


RATE_SQL = """CASE WHEN lower(road_name) LIKE '%thika%' OR lower(road_name) LIKE '%a2%' THEN 3.71::DOUBLE
    WHEN lower(road_name) LIKE '%uca%' THEN 5.29::DOUBLE
    WHEN lower(road_name) LIKE '%mombasa%' OR lower(road_name) LIKE '%a8%' OR lower(road_name) LIKE '%a109%' THEN 2.28::DOUBLE
    WHEN lower(road_name) LIKE '%ucb%' THEN 3.92::DOUBLE END"""


def top_risk_points(spark, sf_dir) -> DataFrame:
    top = roads.top_risk_points(calibrated(spark, sf_dir), 5)
    return roads.fatal_rate_note(top).select("segment_id", "base_risk", "rate_note")


def _hotspots(spark, sf_dir) -> DataFrame:
    """Hotspots measured on the accidents, numbered by road name."""
    measured = roads.hotspots_from_accidents(views.accidents(spark, sf_dir))
    return ordering.with_sequence(measured, ["road"], "rank")


def hotspot_rank(spark, sf_dir) -> DataFrame:
    return roads.rank_hotspots(_hotspots(spark, sf_dir), 12).select("place", "road", "fatal_per_km", "total_annual")


def top_hotspots(spark, sf_dir) -> DataFrame:
    return roads.top_hotspots(_hotspots(spark, sf_dir), 5).select("road", "fatal_per_km", "total_annual")


HOTSPOT_SQL = f"""
, measured AS (
  SELECT road_name AS road, count(*) FILTER (severity = 'Fatal') AS fatal, count(DISTINCT location) AS locations
  FROM accidents GROUP BY road_name
),
rated AS (SELECT road, {o.rnd('fatal / locations::DOUBLE', 6)} AS fatal_per_km, {o.rnd('fatal / years::DOUBLE', 6)} AS total_annual
  FROM measured, (SELECT max(year) - min(year) + 1 AS years FROM accidents))"""


def score_share(spark, sf_dir) -> DataFrame:
    measured = roads.hotspots_from_accidents(views.accidents(spark, sf_dir))
    return patterns.score_share(measured, "total_annual").select("road", "total_annual", r6("share").alias("share"))


def union_rows(spark, sf_dir) -> DataFrame:
    """Points of all roads, road by road, appended to one table."""
    points = views.event_points(spark, sf_dir).select("event_id", "road_name")
    return tables.union_rows(*[points.filter(F.col("road_name") == name) for name in views.ROAD_NAMES])


QUERIES = {
    "road_edges_scan": (
        road_edges_scan,
        sql("SELECT event_id AS edge, name, highway, maxspeed, coalesce(n_points, NULL) AS points FROM edges", o.EDGES),
    ),
    "road_name_match": (
        road_name_match, sql("SELECT event_id, road_name FROM points WHERE lower(road_name) LIKE '%uca2%'", o.POINTS),
    ),
    "high_risk_road": (high_risk_road, sql(f"SELECT event_id, {o.HIGH_RISK} AS high_risk FROM points", o.POINTS)),
    "bbox": (
        bbox,
        sql("""SELECT event_id, latitude, longitude FROM points
WHERE latitude BETWEEN -1.30 AND -1.15 AND longitude BETWEEN 36.65 AND 36.95""", o.POINTS),
    ),
    "dedup_points": (
        dedup_points,
        sql("""SELECT event_id, road_name, segment_id, latitude, longitude FROM (
SELECT *, row_number() OVER (PARTITION BY latitude, longitude ORDER BY event_id) AS n FROM points) WHERE n = 1""", o.POINTS),
    ),
    "line_points": (
        line_points, sql(f"{POINTS_SQL} SELECT event_id AS edge, point, longitude, latitude FROM drawn", o.EDGES),
    ),
    "road_type": (road_type, sql(f"SELECT event_id AS edge, {ROAD_TYPE_SQL} AS road_type FROM edges", o.EDGES)),
    "alias_first_match": (
        alias_first_match, sql(f"{ALIAS_SQL} SELECT event_id AS edge, road_group, road_name FROM matched", o.EDGES),
    ),
    "extract_road_points": (extract_road_points, sql(ALIAS_SQL + EXTRACT_SQL, o.EDGES)),
    "sample_per_group": (
        sample_per_group,
        sql(f"""SELECT event_id, road_name FROM (SELECT *, row_number() OVER (PARTITION BY road_name
ORDER BY {o.draw('CAST(event_id AS VARCHAR)', ':42')}, event_id) AS n FROM points) WHERE n <= 15""", o.POINTS),
    ),
    "road_class": (
        road_class,
        sql(f"SELECT event_id, lanes, speed_limit, {o.rnd('base_risk', 6)} AS base_risk FROM road_database", o.ROAD_DATABASE),
    ),
    "base_risk_adjust": (
        base_risk_adjust,
        sql(f"""SELECT event_id, {o.rnd("least(risk + CASE WHEN high THEN 0.12 ELSE 0.0 END, CASE WHEN high THEN 0.92 ELSE 1.0 END)", 6)} AS base_risk
FROM (SELECT event_id, {o.HIGH_RISK} AS high, [0.72, 0.58, 0.65, 0.85][event_id % 4 + 1]::DOUBLE AS risk FROM points)""", o.POINTS),
    ),
    "calibrate": (
        calibrate,
        sql(f"""SELECT event_id, road_name, {o.rnd(CALIBRATED, 6)} AS base_risk, ({RATE_SQL}) IS NOT NULL AS ntsa_verified,
{RATE_SQL} AS ntsa_fatal_rate FROM road_database""", o.ROAD_DATABASE),
    ),
    "top_risk_points": (
        top_risk_points,
        sql(f"""SELECT segment_id, {o.rnd(CALIBRATED, 6)} AS base_risk,
coalesce(printf('(%.2f fatal/km/year)', {RATE_SQL}), '') AS rate_note
FROM road_database ORDER BY base_risk DESC, segment_id LIMIT 5""", o.ROAD_DATABASE),
    ),
    "hotspot_rank": (
        hotspot_rank,
        sql(f"""{HOTSPOT_SQL} SELECT row_number() OVER (ORDER BY fatal_per_km DESC, road) AS place, road, fatal_per_km,
total_annual FROM rated ORDER BY place LIMIT 12"""),
    ),
    "top_hotspots": (
        top_hotspots, sql(f"{HOTSPOT_SQL} SELECT road, fatal_per_km, total_annual FROM rated ORDER BY fatal_per_km DESC, road LIMIT 5"),
    ),
    "score_share": (
        score_share,
        sql(f"""{HOTSPOT_SQL} SELECT road, total_annual,
{o.rnd('total_annual / (SELECT max(total_annual) FROM rated)', 6)} AS share FROM rated"""),
    ),
    "union_rows": (
        union_rows,
        sql("SELECT event_id, road_name FROM points", o.POINTS),
    ),
}
