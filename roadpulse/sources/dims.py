"""Inline dimension tables. Each has a fixed size, so each may be broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Accident risk factor per hour of day, from 0 to 23.
HOUR_FACTORS = (
    0.30, 0.20, 0.20, 0.20, 0.30, 0.50, 0.80, 1.50, 1.80, 1.20, 1.00, 1.00,
    1.10, 1.20, 1.10, 1.30, 1.50, 2.00, 2.20, 1.80, 1.50, 1.00, 0.70, 0.50,
)

# Accident risk factor per weekday and per weather class.
DAY_FACTORS = {
    "Monday": 1.10,
    "Tuesday": 1.00,
    "Wednesday": 1.00,
    "Thursday": 1.20,
    "Friday": 1.50,
    "Saturday": 0.90,
    "Sunday": 0.70,
}
WEATHER_FACTORS = {
    "Clear": 1.00,
    "Cloudy": 1.05,
    "Light Rain": 1.25,
    "Rain": 1.40,
    "Heavy Rain": 1.70,
    "Fog": 1.30,
}

# Public holidays of 2023 and 2024.
HOLIDAYS = (
    "2023-01-01", "2023-04-07", "2023-04-10", "2023-05-01", "2023-06-01",
    "2023-10-10", "2023-10-20", "2023-12-12", "2023-12-25", "2023-12-26",
    "2024-01-01", "2024-03-29", "2024-04-01", "2024-05-01", "2024-06-01",
    "2024-10-10", "2024-10-20", "2024-12-12", "2024-12-25", "2024-12-26",
)

# Fatal crashes per km and year, yearly total and risk multiplier
# of known hotspots; the order decides which one a road takes.
HOTSPOTS = (
    ("A2S (Thika Road)", 3.71, 32.8, 1.25),
    ("UCA3-Nairobi", 5.29, 26.8, 1.35),
    ("A8 (Mombasa Road)", 2.28, 23.2, 1.20),
    ("A8 (Mombasa Road East)", 1.48, 22.4, 1.15),
    ("UCA1-Nairobi", 2.61, 13.2, 1.18),
    ("UCB3-Nairobi", 3.92, 10.8, 1.22),
    ("UCA3-Nairobi Inner", 3.01, 10.0, 1.15),
    ("UCB20-Nairobi", 3.03, 9.6, 1.15),
    ("UCB19-Nairobi", 2.73, 9.6, 1.12),
    ("A2S (Thika Road North)", 1.50, 9.6, 1.08),
    ("UCA2-Nairobi", 3.51, 7.2, 1.15),
    ("UCA2-Nairobi South", 1.12, 6.8, 1.05),
)

# Keywords of a road name and the tag a hotspot must carry for
# the two to match.
HOTSPOT_FAMILIES = (
    (("thika", "a2"), "thika"),
    (("mombasa", "a8", "a109"), "a8"),
    (("uca",), "uca"),
    (("ucb",), "ucb"),
)

# Road groups with their aliases, in order of preference.
ROAD_ALIASES = {
    "Thika Superhighway": ("Thika Road", "Thika Superhighway", "A2"),
    "Mombasa Road": ("Mombasa Road", "A109"),
    "Waiyaki Way": ("Waiyaki Way", "A104"),
    "Uhuru Highway": ("Uhuru Highway",),
    "Ngong Road": ("Ngong Road",),
    "Jogoo Road": ("Jogoo Road",),
    "Outer Ring Road": ("Outer Ring Road", "Northern Bypass"),
    "Limuru Road": ("Limuru Road",),
    "Kenyatta Avenue": ("Kenyatta Avenue",),
    "Moi Avenue": ("Moi Avenue",),
    "Lang'ata Road": ("Langata Road", "Lang'ata Road"),
    "Eastlands": ("Jogoo Road", "Outering Road"),
}

# Curated points used when no edge table is available:
# group, road, place, latitude, longitude, type.
CURATED_POINTS = (
    ("Thika Superhighway", "Thika Road", "Muthaiga", -1.2389, 36.8619, "highway"),
    ("Thika Superhighway", "Thika Road", "Roysambu", -1.2189, 36.8919, "highway"),
    ("Thika Superhighway", "Thika Road", "Garden City", -1.2256, 36.8956, "highway"),
    ("Thika Superhighway", "Thika Road", "Kasarani", -1.2178, 36.8978, "highway"),
    ("Mombasa Road", "Mombasa Road", "Bunyala", -1.3084, 36.8478, "highway"),
    ("Mombasa Road", "Mombasa Road", "Belle Vue", -1.3156, 36.8889, "highway"),
    ("Mombasa Road", "Mombasa Road", "Gateway Mall", -1.3183, 36.9278, "highway"),
    ("Mombasa Road", "Mombasa Road", "Airport", -1.3195, 36.9256, "highway"),
    ("Waiyaki Way", "Waiyaki Way", "Westlands", -1.2656, 36.8064, "main_road"),
    ("Waiyaki Way", "Waiyaki Way", "ABC Place", -1.2689, 36.7969, "main_road"),
    ("Waiyaki Way", "Waiyaki Way", "Nairobi School", -1.2705, 36.7856, "main_road"),
    ("Uhuru Highway", "Uhuru Highway", "Nyayo Stadium", -1.3014, 36.8269, "highway"),
    ("Uhuru Highway", "Uhuru Highway", "University Way", -1.2789, 36.8169, "highway"),
    ("Ngong Road", "Ngong Road", "Prestige Plaza", -1.2925, 36.7822, "main_road"),
    ("Ngong Road", "Ngong Road", "Junction Mall", -1.3025, 36.7689, "main_road"),
    ("Jogoo Road", "Jogoo Road", "Makadara", -1.2867, 36.8597, "main_road"),
    ("Jogoo Road", "Jogoo Road", "Buruburu", -1.2789, 36.8889, "main_road"),
)

# Locations used when the accident table cannot be read.
FALLBACK_LOCATIONS = (
    ("Mombasa Road Junction", "Mombasa Road", -1.3192, 36.8517, 0.85),
    ("Thika Road Superhighway", "Thika Road", -1.2326, 36.8847, 0.78),
    ("Waiyaki Way Westlands", "Waiyaki Way", -1.2635, 36.8078, 0.72),
)

# Accident type shares per road type.
ACCIDENT_TYPES = {
    "highway": {
        "Vehicle Collision": 0.35,
        "Pedestrian Knockdown": 0.20,
        "Motorcycle Accident": 0.18,
        "Overtaking Accident": 0.12,
        "Speeding": 0.10,
        "Rear-End Collision": 0.05,
    },
    "city_street": {
        "Pedestrian Knockdown": 0.40,
        "Vehicle Collision": 0.25,
        "Motorcycle Accident": 0.15,
        "Matatu Accident": 0.12,
        "Hit and Run": 0.05,
        "Other": 0.03,
    },
    "main_road": {
        "Vehicle Collision": 0.32,
        "Pedestrian Knockdown": 0.28,
        "Motorcycle Accident": 0.18,
        "Matatu Accident": 0.12,
        "Speeding": 0.07,
        "Other": 0.03,
    },
}

# Seasons by month, with the weather shares of each season.
LONG_RAINS = (3, 4, 5)
SHORT_RAINS = (10, 11)
SEASON_WEATHER = {
    "long_rains": {"Clear": 0.35, "Cloudy": 0.20, "Light Rain": 0.20, "Rain": 0.15, "Heavy Rain": 0.10},
    "short_rains": {"Clear": 0.50, "Cloudy": 0.25, "Light Rain": 0.15, "Rain": 0.10},
    "dry": {"Clear": 0.75, "Cloudy": 0.20, "Light Rain": 0.05},
}
UNDATED_MONTH = 6


def season(month: int) -> str:
    if month in LONG_RAINS:
        return "long_rains"
    return "short_rains" if month in SHORT_RAINS else "dry"


def inline(spark: SparkSession, layout: str, rows: list[tuple]) -> DataFrame:
    """Rows as a local relation: the optimizer knows its size and no Python task reads it."""

    def literal(v) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return f"{v!r}D" if isinstance(v, float) else repr(v)

    values = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    fields = [f.split() for f in layout.split(", ")]
    names = ", ".join(name for name, _ in fields)
    casts = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in fields)
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({names})")


def hour_factors(spark: SparkSession) -> DataFrame:
    return inline(spark, "hour int, time_factor double", list(enumerate(HOUR_FACTORS)))


def day_factors(spark: SparkSession) -> DataFrame:
    return inline(spark, "day_of_week string, day_factor double", list(DAY_FACTORS.items()))


def weather_factors(spark: SparkSession) -> DataFrame:
    return inline(spark, "weather string, weather_factor double", list(WEATHER_FACTORS.items()))


def holidays(spark: SparkSession) -> DataFrame:
    return inline(spark, "date string", [(d,) for d in HOLIDAYS])


def hotspots(spark: SparkSession) -> DataFrame:
    rows = [(rank, *row) for rank, row in enumerate(HOTSPOTS)]
    return inline(spark, "rank int, road string, fatal_per_km double, total_annual double, multiplier double", rows)


def curated_points(spark: SparkSession) -> DataFrame:
    """Curated points with the column names the rest of the library expects."""
    rows = [
        (group, road, str(i), lat, lon, kind, None, None, place)
        for i, (group, road, place, lat, lon, kind) in enumerate(CURATED_POINTS)
    ]
    layout = (
        "road_group string, road_name string, segment_id string, latitude double, longitude double, "
        "road_type string, osm_id string, maxspeed string, location string"
    )
    return inline(spark, layout, rows)


def fallback_locations(spark: SparkSession) -> DataFrame:
    layout = "location_name string, road_name string, latitude double, longitude double, base_risk double"
    return inline(spark, layout, list(FALLBACK_LOCATIONS))


def accident_types(spark: SparkSession) -> DataFrame:
    rows = [(road, kind, share) for road, mix in ACCIDENT_TYPES.items() for kind, share in mix.items()]
    return inline(spark, "road_type string, accident_type string, share double", rows)


def season_weather(spark: SparkSession) -> DataFrame:
    """Weather shares of every month."""
    rows = [
        (month, season(month), weather, share)
        for month in range(1, 13)
        for weather, share in SEASON_WEATHER[season(month)].items()
    ]
    return inline(spark, "month int, season string, weather string, share double", rows)


def month_default(month: int) -> dict:
    """Most likely weather of a month with the readings that go with it.

    Readings are the midpoints of the ranges the defaults are drawn from; rain
    and cloud decide precipitation, cloud cover and surface.
    """
    shares = SEASON_WEATHER[season(month)]
    label = max(shares, key=shares.get)
    rain, cloudy = "Rain" in label, "Cloudy" in label
    return {
        "temperature": 21.0,
        "precipitation": 5.0 if rain else 0.0,
        "cloudcover": 80.0 if rain or cloudy else 20.0,
        "windspeed": 10.0,
        "visibility": 10000.0,
        "weather": label,
        "road_surface": "Wet" if rain else "Dry",
    }


def season_defaults(spark: SparkSession) -> DataFrame:
    """Default weather of every month."""
    rows = [(month, *month_default(month).values()) for month in range(1, 13)]
    layout = (
        "month int, temperature double, precipitation double, cloudcover double, windspeed double, "
        "visibility double, weather string, road_surface string"
    )
    return inline(spark, layout, rows)
