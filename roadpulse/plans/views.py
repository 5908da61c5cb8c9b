"""Domain tables derived from the driver's ``events`` and ``embeddings`` tables.

Every row comes from a row of those tables, so the work of a query grows with
them. The same derivations stand as SQL in :mod:`.oracle_views`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.risk import density_estimate, speed_estimate
from ..functions.roads import location_label
from ..functions.text import primary_cause
from ..functions.weather import road_surface_from_label
from ..operators import history, roads, scoring
from ..schemas import ACCIDENT_SCHEMA, ROAD_POINT_SCHEMA, conform
from ..sources import dims

# Road names given to users, by user id modulo 12.
ROAD_NAMES = (
    "Thika Road", "UCA2 Link", "Uhuru Highway", "Moi Avenue", "Mombasa Road", "Waiyaki Way",
    "UCB3 Connector", "Ngong Road", "Jogoo Road", "A109 Bypass", "Kenyatta Avenue", "Outer Ring Road",
)
ROAD_TYPES = ("highway", "main_road", "city_street")
EDGE_TAGS = ("primary", "Highway_link", "secondary", "motorway")
WEATHER_OF_EVENT = {
    "click": "Clear", "view": "Cloudy", "signup": "Light Rain", "purchase": "Rain", "error": "Heavy Rain",
}
PRECIPITATION = {"Light Rain": 0.6, "Rain": 2.5, "Heavy Rain": 7.5}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def choose(values: tuple, index: Column) -> Column:
    """Element of a fixed list by position from 0."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def spread(rows: DataFrame) -> DataFrame:
    """A table of few file splits dealt to all cores, for passes that cost far more than the reading."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def base_events(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """Events with user number u, property k and the names derived from them; ``dealt`` to all cores if asked for."""
    events = table(spark, sf_dir, "events")
    u, k = F.col("u"), F.col("k")
    weather = None
    for kind, label in WEATHER_OF_EVENT.items():
        test = F.col("event_type") == kind
        weather = F.when(test, label) if weather is None else weather.when(test, label)
    return (
        (spread(events) if dealt else events)
        .select(
            "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("u"), "event_type",
            "value", F.get_json_object("props", "$.k").cast("int").alias("k"),
        )
        .withColumns(
            {
                "road_name": choose(ROAD_NAMES, u % 12),
                "road_type": choose(ROAD_TYPES, u % 3),
                "latitude": (F.lit(-145) + u % 31) / 100.0,
                "longitude": (F.lit(3665) + u % 46) / 100.0,
                "weather": weather,
                "severity": F.when(k < 8, "Fatal").when(k < 38, "Serious").otherwise("Minor"),
            }
        )
    )


def accidents(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """Accident table, 42 columns, one row per event. Some locations and temperatures are missing."""
    u, k = F.col("u"), F.col("k")
    kinds = None
    for kind, mix in dims.ACCIDENT_TYPES.items():
        pick = choose(tuple(mix), k % 6)
        kinds = F.when(F.col("road_type") == kind, pick) if kinds is None else kinds.when(F.col("road_type") == kind, pick)
    vehicles = (
        F.when(F.col("accident_type") == "Vehicle Collision", 2 + k % 3)
        .when(F.col("accident_type") == "Pedestrian Knockdown", 1)
        .otherwise(1 + k % 2)
    )
    rain = F.lit(0.0)
    for label, amount in PRECIPITATION.items():
        rain = F.when(F.col("weather") == label, amount).otherwise(rain)
    facts = roads.build_road_database(base_events(spark, sf_dir, dealt)).withColumns(
        {
            "id": F.col("event_id"),
            "accident_id": F.concat(F.lit("NRB"), (F.col("event_id") + 100000).cast("string")),
            "road_group": F.col("road_name"),
            "location": F.when(F.col("event_id") % 97 != 0, F.concat(F.lit("Loc-"), u.cast("string"))),
            "accident_type": kinds,
            "casualties": k % 5 + 1,
            "temperature": F.when(k % 17 != 0, (k % 11 + 16).cast("double")),
            "precipitation": rain,
            "cloudcover": k.cast("double"),
            "windspeed": (u % 11 + 5).cast("double"),
            "visibility": (10000 - 50 * k).cast("double"),
            "road_surface": road_surface_from_label(F.col("weather")),
        }
    ).withColumn("vehicles_involved", vehicles)
    scored = history.with_risk(history.with_risk_factors(history.with_holiday(history.with_calendar(facts))))
    noise = k % 21 - 10
    full = scored.withColumns(
        {
            "traffic_density": density_estimate(F.col("raw_risk_score"), noise),
            "primary_cause": primary_cause(F.col("weather"), F.col("hour"), F.col("accident_type"), F.col("day_of_week")),
        }
    ).withColumn("average_speed", speed_estimate(F.col("speed_limit"), F.col("traffic_density"), noise))
    return conform(full, ACCIDENT_SCHEMA)


def raw_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unscored traffic events, one per event, with the base risk of their place."""
    u = F.col("u")
    return base_events(spark, sf_dir).select(
        F.concat(F.lit("P"), F.col("event_id").cast("string")).alias("PredictionId"),
        F.col("ts").alias("Timestamp"),
        F.col("event_id").cast("string").alias("EventId"),
        F.concat(F.lit("Loc-"), u.cast("string")).alias("LocationName"),
        F.col("road_name").alias("RoadName"),
        F.col("latitude").alias("Latitude"),
        F.col("longitude").alias("Longitude"),
        F.least(F.lit(100), F.floor("value")).cast("int").alias("TrafficDensity"),
        F.col("weather").alias("Weather"),
        ((F.lit(30) + u % 14 * 5) / 100.0).alias("base_risk"),
    )


def traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event table: the raw events scored by the rules."""
    return scoring.score_events(raw_traffic(spark, sf_dir))


def event_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One road point per event; coordinates repeat."""
    segment = F.concat_ws("_", "road_name", F.col("event_id").cast("string"), (F.col("u") % 3).cast("string"))
    points = base_events(spark, sf_dir).withColumns(
        {
            "road_group": F.col("road_name"),
            "segment_id": segment,
            "osm_id": F.col("event_id").cast("string"),
            "maxspeed": F.when(F.col("k") % 2 == 0, "50"),
            "location": location_label(F.col("road_name"), segment),
        }
    )
    return points.select("event_id", *ROAD_POINT_SCHEMA.names)


def road_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One road edge per event: names with suffixes or missing, polylines of up to six points or missing."""
    u, k = F.col("u"), F.col("k")
    line = F.transform(
        F.sequence(F.lit(0), k % 6),
        lambda i: F.struct(
            ((F.lit(3660) + (u + i) % 56) / 100.0).alias("lon"), ((F.lit(-148) + (u + i) % 37) / 100.0).alias("lat")
        ),
    )
    name = F.when(k % 2 == 0, F.concat(F.upper("road_name"), F.lit(" East"))).otherwise(F.col("road_name"))
    return base_events(spark, sf_dir).select(
        F.when(k % 13 != 0, name).alias("name"),
        choose(EDGE_TAGS, u % 4).alias("highway"),
        F.when(k % 2 == 0, "50").alias("maxspeed"),
        F.struct(F.col("event_id").alias("u"), u.alias("v"), (k % 3).alias("k")).alias("edge_key"),
        F.when(k % 19 != 0, line).alias("geometry"),
    )


def weather_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One hourly document per date, from event counts and property sums; every seventh date has no hours."""
    hourly = base_events(spark, sf_dir).groupBy(
        F.date_format("ts", "yyyy-MM-dd").alias("date"), F.hour("ts").alias("hour")
    ).agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("s"))
    n, s = F.col("n"), F.col("s")
    reading = F.struct(
        "hour",
        F.when(n % 5 != 0, (n % 12 + 16) / 1.0).alias("temperature_2m"),
        F.when(s % 3 == 0, 0.0).otherwise(s % 90 / 10.0).alias("precipitation"),
        (s % 101 / 1.0).alias("cloudcover"),
        (s % 200 / 10.0).alias("windspeed_10m"),
        (s * 7 % 12000 / 1.0).alias("visibility"),
    )
    # At most 24 rows per date.
    per_date = hourly.groupBy("date").agg(F.sort_array(F.collect_list(reading)).alias("r"))
    fields = ("temperature_2m", "precipitation", "cloudcover", "windspeed_10m", "visibility")
    hours = F.struct(*[F.col(f"r.{f}").alias(f) for f in fields])
    return per_date.select("date", F.when(F.dayofmonth(F.to_date("date")) % 7 != 0, hours).alias("hourly"))


def weather_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather observations: every view event is one."""
    seen = base_events(spark, sf_dir).filter("event_type = 'view'")
    return seen.select(
        F.col("ts").alias("obs_ts"),
        (F.col("k") % 80 / 10.0).alias("precipitation"),
        (F.col("k") % 11 + 16).cast("double").alias("temperature"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History level as label, live level as prediction, per event."""
    label = accidents(spark, sf_dir).select("id", F.col("risk_level").alias("label"))
    live = traffic(spark, sf_dir).select(
        F.col("EventId").cast("bigint").alias("id"), F.col("RiskLevel").alias("prediction")
    )
    return label.join(live, "id")


def road_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roads.build_road_database(event_points(spark, sf_dir))

