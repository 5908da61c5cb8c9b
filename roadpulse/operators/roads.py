"""Road points: extraction from edges, classes, calibration, rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import clip, rounded
from ..functions.roads import (
    CALIBRATED_RISK_CAP, adjust_base_risk, any_of, class_columns, edge_text, line_points, location_label, name_contains,
    osm_key, road_class, road_type, segment_id,
)
from ..schemas import ROAD_POINT_SCHEMA, conform
from ..sources.dims import HOTSPOT_FAMILIES, ROAD_ALIASES
from .ordering import dedup_first, ranked_top, sample_n, top_n

# Bounding box of the area, and points per road.
BOX = {"latitude": (-1.45, -1.15), "longitude": (36.65, 37.10)}
SAMPLE_PER_ROAD = 15


def match_road(df: DataFrame, name: str, column: str = "road_name") -> DataFrame:
    return df.filter(name_contains(F.col(column), name))


def in_bbox(df: DataFrame, box: dict | None = None) -> DataFrame:
    """Points inside the box, edges included."""
    box = box or BOX
    return df.filter(F.col("latitude").between(*box["latitude"]) & F.col("longitude").between(*box["longitude"]))


def match_aliases(edges: DataFrame, aliases: dict | None = None, name: str = "name") -> DataFrame:
    """Edges of every road group, found by the first alias that matches any edge.

    Adds ``road_group``, ``road_name`` (the alias) and ``group_pos``. The alias
    tests are one projection over the edges; an edge appears once per alias it
    matches, and only the winning alias of a group, found by an aggregate of one
    row per group, is kept.
    """
    aliases = aliases or ROAD_ALIASES
    candidates = []
    for group_pos, (group, names) in enumerate(aliases.items()):
        for alias_pos, alias in enumerate(names):
            found = F.struct(
                F.lit(group_pos).alias("group_pos"), F.lit(alias_pos).alias("alias_pos"),
                F.lit(group).alias("road_group"), F.lit(alias).alias("road_name"),
            )
            candidates.append(F.when(name_contains(F.col(name), alias), found))
    hits = edges.withColumn("__hit", F.explode(F.array_compact(F.array(*candidates))))
    winners = hits.groupBy(F.col("__hit.group_pos").alias("__g")).agg(
        F.min("__hit.alias_pos").alias("__a")
    )
    kept = hits.join(
        F.broadcast(winners),
        (F.col("__hit.group_pos") == F.col("__g")) & (F.col("__hit.alias_pos") == F.col("__a")),
    )
    return kept.withColumns(
        {c: F.col(f"__hit.{c}") for c in ("group_pos", "road_group", "road_name")}
    ).drop("__hit", "__g", "__a")


def edge_points(edges: DataFrame) -> DataFrame:
    """Three points per matched edge that has a geometry, as road points."""
    drawn = edges.filter(F.size("geometry") > 0)
    points = drawn.select("*", F.posexplode(line_points(F.col("geometry"))).alias("point", "xy"))
    segment = segment_id(F.col("road_group"), edge_text(F.col("edge_key")), F.col("point"))
    return points.withColumns(
        {
            "segment_id": segment,
            "latitude": F.col("xy.lat"),
            "longitude": F.col("xy.lon"),
            "road_type": road_type(F.col("highway")),
            "osm_id": osm_key(F.col("edge_key")),
            "location": location_label(F.col("road_name"), segment),
        }
    ).drop("xy")


def extract_road_points(edges: DataFrame, aliases: dict | None = None, seed: int = 42) -> DataFrame:
    """Edges to road points: alias match, sample, three points, dedup, box."""
    matched = match_aliases(edges, aliases)
    sampled = sample_n(matched, "road_group", SAMPLE_PER_ROAD, edge_text(F.col("edge_key")), seed)
    points = edge_points(sampled)
    first = dedup_first(points, ["latitude", "longitude"], ["group_pos", "segment_id"])
    return conform(in_bbox(first), ROAD_POINT_SCHEMA)


def build_road_database(points: DataFrame) -> DataFrame:
    """Lanes, speed limit and base risk of every point."""
    keyed = points.withColumn("__class", road_class(F.col("road_type"), F.col("road_name")))
    known = keyed.withColumns(class_columns(F.col("__class")))
    return known.withColumn("base_risk", adjust_base_risk(F.col("base_risk"), F.col("road_name"))).drop("__class")


def first_hotspot(name: Column, hotspots: DataFrame) -> Column:
    """First hotspot, by rank, that a road name matches; null when none.

    Which hotspot a keyword family can win is known before any road is read, so
    the hotspot table shrinks to one struct per family in a scalar subquery. The
    roads then need one expression and no join.
    """
    entry = F.struct("rank", "multiplier", "fatal_per_km")
    best = [F.min(F.when(F.lower("road").contains(tag), entry)) for _, tag in HOTSPOT_FAMILIES]
    table = hotspots.select(F.array(*best).alias("best")).scalar()
    hits = [
        F.when(any_of([name_contains(name, k) for k in keywords]), F.get(table, F.lit(i)))
        for i, (keywords, _) in enumerate(HOTSPOT_FAMILIES)
    ]
    return F.array_min(F.array(*hits))


def calibrate(roads: DataFrame, hotspots: DataFrame) -> DataFrame:
    """Raise base risk by the multiplier of the first matching hotspot, cap, and mark it."""
    hit = first_hotspot(F.col("road_name"), hotspots)
    marked = roads.withColumn("__hit", hit)
    return marked.withColumns(
        {
            "base_risk": clip(
                F.col("base_risk") * F.coalesce(F.col("__hit.multiplier"), F.lit(1.0)), hi=CALIBRATED_RISK_CAP
            ),
            "ntsa_verified": F.col("__hit").isNotNull(),
            "ntsa_fatal_rate": F.col("__hit.fatal_per_km"),
        }
    ).drop("__hit")


def top_risk_points(points: DataFrame, k: int = 5) -> DataFrame:
    """Points with the highest base risk; ties by segment."""
    return top_n(points, [F.desc("base_risk"), F.asc("segment_id")], k)


def fatal_rate_note(points: DataFrame) -> DataFrame:
    """Display text of the fatal rate, only for points that have one."""
    rate = F.col("ntsa_fatal_rate")
    note = F.concat(F.lit("("), F.format_string("%.2f", rate), F.lit(" fatal/km/year)"))
    return points.withColumn("rate_note", F.when(rate.isNotNull(), note).otherwise(""))


def top_hotspots(hotspots: DataFrame, k: int = 5) -> DataFrame:
    """Hotspots with the highest fatal rate; ties keep table order."""
    return top_n(hotspots, [F.desc("fatal_per_km"), F.asc("rank")], k)


def rank_hotspots(hotspots: DataFrame, k: int) -> DataFrame:
    """The ``k`` worst hotspots with their place."""
    return ranked_top(hotspots, [F.desc("fatal_per_km"), F.asc("rank")], k, "place")


def hotspots_from_accidents(accidents: DataFrame) -> DataFrame:
    """Hotspot table measured from history, one row per road.

    ``fatal_per_km`` is fatal accidents by location, which stands for a kilometre;
    ``total_annual`` is fatal accidents by calendar year that the whole table touches.
    """
    years = accidents.select(F.year(F.max(F.to_date("date"))) - F.year(F.min(F.to_date("date"))) + 1).scalar()
    fatal = F.count_if(F.col("severity") == "Fatal")
    per_road = accidents.groupBy(F.col("road_name").alias("road")).agg(
        fatal.alias("fatal"), F.countDistinct("location").alias("locations"),
    )
    return per_road.select(
        "road",
        rounded(F.col("fatal") / F.col("locations"), 6).alias("fatal_per_km"),
        rounded(F.col("fatal") / years, 6).alias("total_annual"),
    )
