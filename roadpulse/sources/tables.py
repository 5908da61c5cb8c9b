"""Batch tables: accident history, road edges, sinks and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions.calendar import ISO_FORMAT
from ..schemas import ACCIDENT_SCHEMA, ROAD_EDGE_SCHEMA
from . import dims


def read_accidents(spark: SparkSession, source: str) -> DataFrame:
    """Accident table by path or by catalog name."""
    if "/" in source:
        return spark.read.schema(ACCIDENT_SCHEMA).parquet(source)
    return spark.read.table(source)


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ROAD_EDGE_SCHEMA).parquet(path)


def read_road_points_or_curated(spark: SparkSession, path: str) -> DataFrame:
    """Road points; the curated ones when the table does not exist."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return dims.curated_points(spark)


def save_table(df: DataFrame, name: str, bucket_by: str | None = None, buckets: int = 200) -> None:
    """Replace a managed table, bucketed where later joins share a key."""
    writer = df.write.mode("overwrite")
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(name)


def save_parquet(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def save_csv(df: DataFrame, path: str) -> None:
    """CSV copy with a header line and no index column."""
    df.write.mode("overwrite").option("header", True).csv(path)


def to_event_json(df: DataFrame) -> DataFrame:
    """One JSON text per row; nulls are written, times keep microseconds."""
    options = {"ignoreNullFields": "false", "timestampFormat": ISO_FORMAT}
    return df.select(F.to_json(F.struct(*df.columns), options).alias("value"))


def save_event_json(df: DataFrame, path: str) -> None:
    """JSON lines as a producer would leave them for the stream source."""
    to_event_json(df).write.mode("append").text(path)


def apply_retention(df: DataFrame, as_of: Column, days: int = 1, ts: str = "EventEnqueuedUtcTime") -> DataFrame:
    """Rows enqueued within the retention time before ``as_of``."""
    return df.filter(F.col(ts) > as_of - F.expr(f"INTERVAL {days} DAYS"))


def existing(df: DataFrame, columns: list[str]) -> list[str]:
    """Those of the wanted columns that the frame has."""
    have = set(df.columns)
    return [c for c in columns if c in have]


def union_rows(*frames: DataFrame) -> DataFrame:
    """Append frames by column name."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
