"""What the physical plans must and must not contain."""

from roadpulse.operators import patterns
from roadpulse.plans import registry, views


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_pattern_aggregates_hash_before_the_shuffle(spark, sf_dir):
    text = plan(patterns.location_patterns(views.accidents(spark, sf_dir)))
    assert "SortAggregate" not in text and "partial_count" in text


def test_lookup_tables_are_pruned_and_scans_are_narrow(spark, sf_dir):
    text = plan(patterns.recent_counts(views.accidents(spark, sf_dir)))
    assert "Join" not in text
    assert "props" not in text.split("ReadSchema: ")[1].split("\n")[0]


def test_group_sample_limits_before_the_shuffle(spark, sf_dir):
    assert "WindowGroupLimit" in plan(registry.queries()["sample_per_group"](spark, sf_dir))


def test_calibration_needs_no_join_or_shuffle(spark, sf_dir):
    outer = plan(registry.queries()["calibrate"](spark, sf_dir)).split("Subquery")[0]
    assert "Join" not in outer and "Exchange" not in outer


def test_top_k_is_taken_per_task(spark, sf_dir):
    for name in ("live_feed_24h", "top_risk_points", "head"):
        assert "TakeOrderedAndProject" in plan(registry.queries()[name](spark, sf_dir))


def test_training_deals_a_small_file_to_all_cores(spark, sf_dir):
    """A file of one split would be read, derived and encoded by one task in every pass."""
    cores = spark.sparkContext.defaultParallelism
    dealt, plain = views.accidents(spark, sf_dir, dealt=True), views.accidents(spark, sf_dir)
    assert plain.rdd.getNumPartitions() < cores == dealt.rdd.getNumPartitions()
    assert dealt.count() == plain.count() and dealt.exceptAll(plain).isEmpty()
