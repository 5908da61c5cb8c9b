"""No value, class or row is lost at size; old partitions are not read; scratch space is shared."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from roadpulse import session
from roadpulse.functions.numeric import rounded
from roadpulse.operators import dashboard, evaluation, patterns
from roadpulse.sources import models
from pyspark.ml.functions import array_to_vector
from roadpulse.operators import history, training
from roadpulse.sources import dims, weather_docs
from roadpulse.streaming import summaries


def test_large_numbers_are_rounded(spark):
    got = spark.createDataFrame([(3e10,), (1e20,), (0.1234565,)], "x double").select(rounded(F.col("x"), 6)).collect()
    assert [r[0] for r in got] == [3e10, 1e20, 0.123457]


def test_unknown_predictions_are_counted(spark):
    pred = spark.createDataFrame([("High", "Severe"), ("High", "High"), ("High", None)], "label string, prediction string")
    row = evaluation.confusion(pred).first().asDict()
    assert row == {"label": "High", "High": 1, "Low": 0, "Medium": 0, "other": 2}


def test_most_frequent_takes_any_value(spark):
    rows = spark.createDataFrame([("a", "Mon"), ("a", "Mon"), ("a", "Monday"), ("b", "Tue"), ("b", "Sun"), ("c", None)], "g string, d string")
    got = dict(rows.groupBy("g").agg(patterns.most_frequent(F.col("d"), "Monday")).collect())
    assert got == {"a": "Mon", "b": "Sun", "c": "Monday"}


def test_recent_counts_skip_unknown_places(spark):
    rows = spark.createDataFrame([("x", "2024-01-02"), (None, "2024-01-02")], "location string, date string")
    assert [tuple(r) for r in patterns.recent_counts(rows).collect()] == [("x", 1)]


def test_old_event_dates_are_not_read(spark, tmp_path):
    path = str(tmp_path / "events")
    rows = [(dt.datetime(2024, 1, d, 12), float(d)) for d in range(1, 20)]
    spark.createDataFrame(rows, "Timestamp timestamp, v double").withColumn("event_date", F.to_date("Timestamp")).write.partitionBy("event_date").parquet(path)
    seen = dashboard.recent(spark.read.parquet(path), "24 HOURS", F.lit(dt.datetime(2024, 1, 19, 12)))
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: ")[1].split("]")[0] and [r.v for r in seen.collect()] == [19.0]


def test_missing_model_only(tmp_path, spark):
    assert models.load_model_or_none(str(tmp_path / "none")) is None
    broken = tmp_path / "broken" / "metadata"
    broken.mkdir(parents=True)
    (broken / "part-00000").write_text("no json\n")
    with pytest.raises(Exception):
        models.load_model_or_none(str(broken.parent))


def test_scratch_space_has_to_be_shared_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError):
        session.shared_dir(Session())


def test_asof_with_all_events_in_one_slot(spark):
    ev = spark.range(5000).select(F.col("id").cast("string").alias("EventId"), F.timestamp_seconds(F.lit(600) + F.col("id") % 300).alias("Timestamp"))
    obs = spark.createDataFrame([(590, 1.0), (700, 2.0)], "s int, precipitation double").select(F.timestamp_seconds("s").alias("obs_ts"), "precipitation")
    for asof in (history.weather_asof, history.weather_asof_ordered):
        got = {r.precipitation: r.n for r in asof(ev, obs).groupBy("precipitation").agg(F.count("*").alias("n")).collect()}
        assert got == {1.0: sum(i % 300 < 100 for i in range(5000)), 2.0: sum(i % 300 >= 100 for i in range(5000))}


def test_asof_plans_without_running_a_job(spark):
    tracker, before = spark.sparkContext.statusTracker(), None
    ev = spark.range(10).select(F.col("id").alias("EventId"), F.timestamp_seconds("id").alias("Timestamp"))
    obs = spark.range(3).select(F.timestamp_seconds("id").alias("obs_ts"), F.lit(1.0).alias("p"))
    before = set(tracker.getJobIdsForGroup())
    history.weather_asof(ev, obs)
    assert set(tracker.getJobIdsForGroup()) == before


def test_uneven_weather_readings_take_the_month(spark):
    rows = [("2024-04-01", [20.5, 21.5], [0.0, 0.0]), ("2024-04-02", [20.5, 21.5], [0.0]), ("2024-04-03", [], [])]
    hours = F.struct(*[F.col("t" if f == "temperature_2m" else "x").alias(f) for f in weather_docs.HOURLY_FIELDS.values()])
    docs = spark.createDataFrame(rows, "date string, t array<double>, x array<double>").select("date", hours.alias("hourly"))
    got = {r.date: (r.temperature, r.weather) for r in weather_docs.weather_days(docs).collect()}
    april = dims.month_default(4)
    assert got == {"2024-04-01": (21.5, "Clear"), "2024-04-02": (21.0, april["weather"]), "2024-04-03": (21.0, april["weather"])}


def test_only_observations_of_the_span_are_read(spark):
    obs = spark.range(0, 2000, 100).select(F.timestamp_seconds("id").alias("obs_ts"))
    first, last = spark.range(1).select(F.timestamp_seconds(F.lit(1000)), F.timestamp_seconds(F.lit(1200))).first()
    assert sorted(r.s for r in summaries.in_span(obs, first, last).select(F.unix_seconds("obs_ts").alias("s")).collect()) == list(range(700, 1300, 100))
    assert summaries.in_span(obs, None, None).count() == 0


def test_boosted_models_have_importances(spark):
    rows = spark.range(300).select((F.col("id") % 3).cast("double").alias("label"), F.array((F.col("id") % 3).cast("double"), F.lit(1.0)).alias("v"))
    rows = rows.select("label", array_to_vector("v").alias("features"))
    for estimator in (training.gbt(2, 2), training.adaboost(25)):
        got = {r.feature: r.importance for r in training.importance(estimator.fit(rows), ["real", "none"], spark).collect()}
        assert got["real"] == pytest.approx(1.0) and got["none"] == 0.0
