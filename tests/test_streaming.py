"""Streams give what the same question gives on the table."""

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import dashboard
from roadpulse.plans import views
from roadpulse.schemas import EVENT_SCHEMA, INGEST_SCHEMA
from roadpulse.sources import tables
from roadpulse.streaming import ingest, summaries


@pytest.fixture(scope="module")
def landed(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landed") / "json")
    tables.save_event_json(views.traffic(spark, sf_dir).repartition(4), path)
    return path


def finish(query):
    query.awaitTermination(120)
    assert query.exception() is None


def test_ingest_is_exactly_once_and_partitioned(spark, sf_dir, landed, tmp_path):
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    for _ in range(2):
        finish(ingest.start_ingest(spark, landed, out, ckpt, once=True))
    table = spark.read.parquet(out)
    assert table.columns == [*EVENT_SCHEMA.names, *INGEST_SCHEMA.names, "event_date"]
    want = views.traffic(spark, sf_dir)
    got = table.select(*EVENT_SCHEMA.names)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert table.filter("PartitionId is null or EventEnqueuedUtcTime is null").count() == 0


def test_bad_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "in").mkdir()
    good = '{"EventId":"1","Timestamp":"2024-01-01T00:00:00.000001","RiskScore":0.91,"AlertTriggered":true,"AlertSentTime":null}'
    (tmp_path / "in" / "a.json").write_text(good + "\nno event\n")
    lines = ingest.read_lines(spark, str(tmp_path / "in"))
    for name, part in (("good", ingest.accepted(lines)), ("bad", ingest.rejected(lines))):
        finish(ingest.start_table(part, str(tmp_path / name), str(tmp_path / f"{name}-ckpt"), once=True, partition_by=None))
    event = spark.read.parquet(str(tmp_path / "good")).collect()
    assert len(event) == 1 and event[0].RiskScore == 0.91 and event[0].AlertTriggered is True
    assert [r.line for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == ["no event"]


def test_trend_drops_late_rows_that_the_table_keeps(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    line = '{{"EventId":"{}","Timestamp":"2024-01-01T{}:00.000000","RoadName":"R","TrafficDensity":50,"RiskScore":0.5,"RiskLevel":"Low","AlertTriggered":false}}\n'
    out, ckpt = str(tmp_path / "trend"), str(tmp_path / "trend-ckpt")

    def run():
        trend = summaries.trend_stream(ingest.read_events(spark, str(source)))
        finish(ingest.start_table(trend, out, ckpt, once=True, partition_by=None))
        finish(ingest.start_ingest(spark, str(source), str(tmp_path / "table"), str(tmp_path / "table-ckpt"), once=True))

    (source / "a.json").write_text(line.format(1, "00:01") + line.format(2, "00:02") + line.format(3, "01:00"))
    run()
    (source / "b.json").write_text(line.format(4, "00:03") + line.format(5, "02:00"))
    run()
    trend = spark.read.parquet(out)
    first = trend.filter(F.date_format("Timestamp", "HH:mm") == "00:00").collect()
    assert len(first) == 1
    assert spark.read.parquet(str(tmp_path / "table")).count() == 5


def test_snapshots_replace_a_batch_that_runs_again(spark, landed, tmp_path):
    out = str(tmp_path / "stats")
    for attempt in ("one", "two"):
        stats = summaries.stats_stream(ingest.read_events(spark, landed))
        finish(summaries.start_snapshots(stats, out, str(tmp_path / attempt), once=True))
    rows = summaries.latest_snapshot(spark.read.parquet(out)).collect()
    assert len(rows) == 1 and rows[0].events_generated == 1000


def test_weather_fallback_shares(spark):
    frame = spark.range(4000).select(F.col("id").cast("string").alias("EventId"))
    got = {r.w: r["count"] / 4000 for r in frame.groupBy(summaries.fallback_weather("EventId").alias("w")).count().collect()}
    assert got == pytest.approx({"Clear": 0.7, "Light Rain": 0.2, "Rain": 0.1}, abs=0.03)


def test_retention(spark):
    frame = spark.createDataFrame([(0,), (86_400,), (86_401,)], "s int").withColumn("EventEnqueuedUtcTime", F.timestamp_seconds("s"))
    kept = tables.apply_retention(frame, F.timestamp_seconds(F.lit(172_800)))
    assert [r.s for r in kept.collect()] == [86_401]
    assert dashboard.LOOKBACKS["weather_impact"] == "2 hours"


def test_sliding_windows_of_panes(spark, tmp_path):
    """Many events a pane, gaps, late and missing values: windows equal those made of the events themselves."""
    place = ("'a' AS LocationName", "'r' AS RoadName", "1D AS Latitude", "2D AS Longitude")
    made = spark.range(4000).selectExpr(
        "timestamp_seconds(1700000000 + id * id % 5400) AS Timestamp", *place,
        "if(id % 9 = 0, null, id % 70 + 0.25D) AS TrafficDensity", "(id % 100) / 100D AS RiskScore",
    )
    source = str(tmp_path / "events")
    made.write.parquet(source)
    stream = summaries.sliding_risk(spark.readStream.schema(made.schema).parquet(source), watermark="0 seconds")
    out = str(tmp_path / "out")
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "ckpt"))
    query.trigger(availableNow=True).start().awaitTermination()
    windows = spark.read.parquet(source).groupBy(F.window("Timestamp", "15 minutes", "1 minute").alias("w"))
    plain = windows.agg(F.count(F.lit(1)).alias("n"), F.avg("TrafficDensity").alias("d"), F.avg("RiskScore").alias("s"))
    last = spark.read.parquet(source).agg(F.max("Timestamp")).first()[0]
    want = {r.w.end: r for r in plain.collect() if r.w.end <= last}
    got = {r.WindowEnd: r for r in spark.read.parquet(out).collect()}
    assert set(got) == set(want) and len(got) > 60
    for end, r in got.items():
        assert r.EventCount == want[end].n and abs(r.AvgDensity - want[end].d) <= 0.0501 and abs(r.AvgRiskScore - want[end].s) <= 0.000501
