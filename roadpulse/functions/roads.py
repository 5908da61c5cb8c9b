"""Road geometry, naming and road-class expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import clip

# Name fragments of high-risk roads, their surcharge and the caps.
HIGH_RISK_FRAGMENTS = ("Waiyaki Way", "Thika", "Mombasa Road", "Uhuru Highway")
HIGH_RISK_SURCHARGE = 0.12
BASE_RISK_CAP = 0.92
CALIBRATED_RISK_CAP = 0.95

# Lanes, speed limit and base risk of the three road classes,
# and the name fragments that make a road a street.
ROAD_CLASSES = {
    "highway": (6, 80, 0.72),
    "street": (4, 40, 0.58),
    "main": (4, 60, 0.65),
}
STREET_FRAGMENTS = ("avenue", "kenyatta", "moi")


def name_contains(name: Column, fragment) -> Column:
    """Case-insensitive containment; a missing name never matches."""
    needle = fragment if isinstance(fragment, Column) else F.lit(fragment)
    return F.coalesce(F.lower(name).contains(F.lower(needle)), F.lit(False))


def any_of(tests: list[Column]) -> Column:
    out = F.lit(False)
    for test in tests:
        out = out | test
    return out


def is_high_risk_road(name: Column) -> Column:
    return F.coalesce(name.rlike("(?i)" + "|".join(HIGH_RISK_FRAGMENTS)), F.lit(False))


def road_type(tag: Column) -> Column:
    """Map tag to road type: only the motorway test ignores case."""
    return (
        F.when(F.lower(tag).contains("highway"), "highway")
        .when(tag.contains("primary"), "main_road")
        .otherwise("city_street")
    )


def road_class(type_: Column, name: Column) -> Column:
    """Class key of a road: highway, street or main."""
    street = (type_ == "city_street") | any_of([name_contains(name, f) for f in STREET_FRAGMENTS])
    return (
        F.when((type_ == "highway") | name_contains(name, "highway"), "highway").when(street, "street").otherwise("main")
    )


def class_columns(key: Column) -> dict[str, Column]:
    """Lanes, speed limit and base risk of a class key."""
    columns = {}
    for i, name in enumerate(("lanes", "speed_limit", "base_risk")):
        highway, street, main = (ROAD_CLASSES[k][i] for k in ("highway", "street", "main"))
        columns[name] = F.when(key == "highway", highway).when(key == "street", street).otherwise(main)
    return columns


def adjust_base_risk(base: Column, name: Column) -> Column:
    """Surcharge for high-risk roads, then the cap."""
    return clip(base + F.when(is_high_risk_road(name), HIGH_RISK_SURCHARGE).otherwise(0.0), hi=BASE_RISK_CAP)


def line_points(geometry: Column) -> Column:
    """Start, middle and end point of a polyline, as an array of three points."""
    middle = F.floor(F.size(geometry) / 2).cast("int")
    return F.array(F.get(geometry, F.lit(0)), F.get(geometry, middle), F.try_element_at(geometry, F.lit(-1)))


def segment_id(group: Column, edge: Column, point: Column) -> Column:
    return F.concat_ws("_", group, edge.cast("string"), point.cast("string"))


def location_label(road_name: Column, segment: Column) -> Column:
    """Road name plus the last part of the segment id."""
    return F.concat(road_name, F.lit(" Segment "), F.element_at(F.split(segment, "_"), -1))


def edge_text(edge_key: Column) -> Column:
    """Composite edge key as text, written like a tuple."""
    return F.concat(
        F.lit("("), F.concat_ws(", ", edge_key["u"], edge_key["v"], edge_key["k"]), F.lit(")")
    )


def osm_key(edge_key: Column) -> Column:
    """Third part of a composite edge key."""
    return edge_key["k"].cast("string")
