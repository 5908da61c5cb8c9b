"""JSON events to the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.calendar import ISO_FORMAT
from ..operators.dashboard import alerts
from ..schemas import EVENT_SCHEMA, INGEST_SCHEMA

_BAD = "_corrupt_record"

# Number of partition ids that landed files are spread over.
PARTITION_IDS = 32


def _wire_schema() -> T.StructType:
    return T.StructType([*EVENT_SCHEMA.fields, T.StructField(_BAD, T.StringType())])


def read_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Landed UTF-8 JSON lines as a stream, with the line itself where it cannot be parsed."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    options = {"timestampFormat": ISO_FORMAT, "columnNameOfCorruptRecord": _BAD}
    parsed = F.from_json("value", _wire_schema(), options).alias("event")
    lines = with_ingest_metadata(reader.text(path))
    return lines.select(parsed, *INGEST_SCHEMA.names).select("event.*", *INGEST_SCHEMA.names)


def with_ingest_metadata(df: DataFrame) -> DataFrame:
    """Processing time, partition id from the file, and time the file was enqueued."""
    file = F.col("_metadata.file_path")
    added = {
        "EventProcessedUtcTime": F.current_timestamp(),
        "PartitionId": F.pmod(F.xxhash64(file), F.lit(PARTITION_IDS)),
        "EventEnqueuedUtcTime": F.col("_metadata.file_modification_time"),
    }
    return df.select("*", *[added[f.name].cast(f.dataType).alias(f.name) for f in INGEST_SCHEMA.fields])


def accepted(lines: DataFrame) -> DataFrame:
    """Parsed events, every column passed through."""
    return lines.filter(F.col(_BAD).isNull()).drop(_BAD)


def rejected(lines: DataFrame) -> DataFrame:
    """Lines that are no event, for a table of their own."""
    return lines.filter(F.col(_BAD).isNotNull()).select(F.col(_BAD).alias("line"), *INGEST_SCHEMA.names)


def read_events(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    return accepted(read_lines(spark, path, max_files))


def start_table(
    df: DataFrame, out: str, checkpoint: str, once: bool = False, partition_by: str | None = "event_date",
    every: str = "8 seconds",
) -> StreamingQuery:
    """Append a stream to a parquet table, partitioned by event date unless told otherwise."""
    if partition_by == "event_date":
        df = df.withColumn("event_date", F.to_date("Timestamp"))
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)
    return writer.start(out)


def start_ingest(spark: SparkSession, source: str, out: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Source folder to event table, pass-through."""
    return start_table(read_events(spark, source), out, checkpoint, once)


def start_alerts(events: DataFrame, out: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Alert rows of a stream to a table of their own."""
    return start_table(alerts(events), out, checkpoint, once)
