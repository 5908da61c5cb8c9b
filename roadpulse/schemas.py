"""Table layouts. Column order is part of the contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}


def layout(text: str) -> T.StructType:
    """Schema from lines of ``type: name name ...``."""
    fields = []
    for line in text.strip().splitlines():
        kind, names = line.split(":")
        fields += [T.StructField(n, _TYPES[kind.strip()]) for n in names.split()]
    return T.StructType(fields)


# The accident table, 42 columns.
ACCIDENT_SCHEMA = layout(
    """
    string: accident_id timestamp date time
    int: year month
    string: month_name
    int: day hour
    string: day_of_week
    boolean: is_weekend is_rush_hour is_holiday
    string: road_name road_group location
    double: latitude longitude
    string: road_type
    int: lanes speed_limit
    string: weather
    double: temperature precipitation cloudcover windspeed visibility
    string: road_surface severity accident_type
    int: casualties vehicles_involved
    string: primary_cause
    int: traffic_density average_speed
    double: risk_score
    string: risk_level
    double: base_location_risk time_risk_factor weather_risk_factor day_risk_factor
    bigint: id
    """
)

# One scored traffic event, 20 columns.
EVENT_SCHEMA = layout(
    """
    string: PredictionId
    timestamp: Timestamp
    string: EventId LocationName RoadName
    double: Latitude Longitude
    string: RiskLevel
    double: RiskScore RiskProbabilityHigh RiskProbabilityMedium RiskProbabilityLow Confidence
    string: PrimaryFactors AIExplanation
    int: TrafficDensity
    string: Weather
    int: Hour
    boolean: AlertTriggered
    timestamp: AlertSentTime
    """
)

# What ingestion adds to an event.
INGEST_SCHEMA = layout(
    """
    timestamp: EventProcessedUtcTime
    bigint: PartitionId
    timestamp: EventEnqueuedUtcTime
    """
)

ROAD_POINT_SCHEMA = layout(
    """
    string: road_group road_name segment_id
    double: latitude longitude
    string: road_type osm_id maxspeed location
    """
)

ROAD_EDGE_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("highway", T.StringType()),
        T.StructField("maxspeed", T.StringType()),
        T.StructField("edge_key", layout("bigint: u v\nint: k")),
        T.StructField("geometry", T.ArrayType(layout("double: lon lat"))),
    ]
)

WEATHER_DOC_SCHEMA = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField(
            "hourly",
            T.StructType(
                [
                    T.StructField(n, T.ArrayType(T.DoubleType()))
                    for n in (
                        "temperature_2m", "precipitation", "cloudcover", "windspeed_10m", "visibility",
                    )
                ]
            ),
        ),
    ]
)

WEATHER_DAY_SCHEMA = layout(
    """
    string: date
    double: temperature precipitation cloudcover windspeed visibility
    string: weather road_surface
    """
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of a layout in its order and types."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
