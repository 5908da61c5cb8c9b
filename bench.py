"""Bench: headline queries on one data folder, one JSON line.

``BENCH_SF_DIR`` names the folder, ``BENCH_CPUS`` the local cores. Every query is
built and run to the end twice; the second time counts, so that JVM warm-up does
not. Rows go to a sink that discards them.
"""

from __future__ import annotations

import json
import os
import time

from roadpulse.plans import registry, views
from roadpulse.operators import patterns
from roadpulse.session import local_session

HEADLINE = (
    "location_patterns", "location_profile", "enrich_accidents", "risk_score_hist", "weather_asof",
    "weather_asof_ordered", "sequence_id", "calibrate", "dedup_points", "alias_first_match",
    "score_stream", "risk_heatmap_24h", "risk_trend_24h", "weather_impact_24h", "live_feed_24h",
    "corr_matrix", "anova_f", "mutual_info", "stratified_split", "knn_classify", "train_tree",
    "stream_to_table", "trend_stream",
)


def lineitem_patterns(spark, sf_dir):
    """Location patterns over the largest table: suppliers as places, return flags as severity."""
    from pyspark.sql import functions as F

    rows = views.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("Loc-"), F.col("l_suppkey").cast("string")).alias("location"),
        F.col("l_linestatus").alias("road_name"),
        (F.col("l_suppkey") % 31 / 100.0).alias("latitude"),
        (F.col("l_suppkey") % 46 / 100.0).alias("longitude"),
        F.col("l_orderkey").cast("string").alias("accident_id"),
        F.when(F.col("l_returnflag") == "R", "Fatal").otherwise("Minor").alias("severity"),
        (F.col("l_quantity") / 50.0).alias("risk_score"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        (F.col("l_orderkey") % 24).cast("int").alias("hour"),
        F.date_format("l_shipdate", "EEEE").alias("day_of_week"),
    )
    return patterns.location_patterns(rows, updated_at="2024-01-31 00:00:00")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "roadpulse-bench")
    spark.sparkContext.setLogLevel("ERROR")
    runs = {name: registry.queries()[name] for name in HEADLINE}
    runs["lineitem_patterns"] = lineitem_patterns
    seconds = {}
    for name, run in runs.items():
        for _ in range(2):
            start = time.perf_counter()
            run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
