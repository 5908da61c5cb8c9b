"""Patterns and profiles kept up to date by day.

A table of mergeable partial sums, partitioned by day, stands for the accident history: a changed day is read and
written alone, and patterns and profiles are made of the partial rows of all days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.risk import severity_score
from .patterns import PATTERN_KEYS, PEAK_DEFAULTS, pattern_rows, profile_rows

PLACE = list(PATTERN_KEYS)
PEAKS = ["hour", "day_of_week"]
SUMS = ["n", "ids", "fatal", "risk_sum", "risk_n", "severity_sum", "severity_n"]


def day_partials(accidents: DataFrame, key: str = "id") -> DataFrame:
    """Sums by day, place, hour and weekday; ``first_key`` is the smallest key. A null in a place is a place of its own."""
    severity = severity_score(F.col("severity"))
    return accidents.groupBy(F.to_date("date").alias("day"), *PLACE, *PEAKS).agg(
        F.count(F.lit(1)).alias("n"), F.count("accident_id").alias("ids"), F.count_if(F.col("severity") == "Fatal").alias("fatal"),
        F.sum("risk_score").alias("risk_sum"), F.count("risk_score").alias("risk_n"),
        F.sum(severity).alias("severity_sum"), F.count(severity).alias("severity_n"), F.min(key).alias("first_key"),
    )


def write_partials(accidents: DataFrame, path: str, key: str = "id") -> None:
    """The whole table of partial rows."""
    day_partials(accidents, key).hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(path)


def update_days(accidents: DataFrame, path: str, days: list[str], key: str = "id") -> None:
    """Replace the partial rows of some days (ISO dates); only the accidents of those days are read, where the
    table is partitioned by date, and no other day is written.

    A day without accidents is replaced too: every day gets a row of nothing. A repeated update changes nothing.
    """
    made = day_partials(accidents.filter(F.col("date").isin(days)), key)
    empty = accidents.sparkSession.createDataFrame([(d,) for d in days], "day string").select(
        F.col("day").cast("date").alias("day"), *[F.lit(0).cast(made.schema[c].dataType).alias(c) for c in SUMS]
    )
    rows = made.unionByName(empty, allowMissingColumns=True).hint("rebalance", "day")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def peak(column: str, default) -> Column:
    """Most frequent value of a column among ``peaks``, the smallest on ties."""
    values = F.array_distinct(F.transform("peaks", lambda p: p[column]))

    def counted(v: Column) -> Column:
        n = F.aggregate(F.filter("peaks", lambda p: p[column] == v), F.lit(0).cast("long"), lambda acc, p: acc + p["n"])
        return F.struct((-n).alias("less"), v.alias("value"))

    best = F.array_min(F.transform(F.filter(values, lambda v: v.isNotNull()), counted))
    return F.coalesce(best["value"], F.lit(default))


def patterns_of(partials: DataFrame, strict_30d: bool = False, updated_at: str | None = None) -> DataFrame:
    """:func:`patterns.location_patterns` from partial rows, in one scan once the last day is known."""
    real = partials.filter("n > 0")
    last = F.lit(real.agg(F.max("day")).first()[0]).cast("date")
    week = F.when(F.col("day") >= F.date_sub(last, 7), F.col("n"))
    month = (F.col("day") >= F.date_sub(last, 30)) if strict_30d else F.lit(True)
    # A week is part of the month, so strict counts need no older partitions.
    used = real.filter(month)
    cells = used.groupBy(*PLACE, *PEAKS).agg(
        *[F.sum(c).alias(c) for c in ("n", "ids", "fatal", "risk_sum", "risk_n")], F.sum(week).alias("week"), F.max("day").alias("last")
    )
    # At most a row per hour and weekday of a place.
    grouped = cells.groupBy(*PLACE).agg(
        F.sum("ids").alias("AccidentCount_30d"), F.sum("fatal").alias("FatalCount_30d"),
        F.try_divide(F.sum("risk_sum"), F.sum("risk_n")).alias("AvgRiskScore"),
        F.date_format(F.max("last"), "yyyy-MM-dd").alias("LastAccidentDate"),
        F.sum("week").alias("week"), F.collect_list(F.struct(*PEAKS, "n")).alias("peaks"),
    )
    # Few rows per location name.
    named = grouped.withColumn("AccidentCount_7d", F.coalesce(F.sum("week").over(Window.partitionBy("location")), F.lit(0).cast("long")))
    known = named.filter(" and ".join(f"{c} is not null" for c in PLACE))
    ready = known.withColumns({"PeakRiskHour": peak("hour", PEAK_DEFAULTS[0]), "PeakRiskDay": peak("day_of_week", PEAK_DEFAULTS[1])})
    return pattern_rows(ready.withColumnsRenamed(PATTERN_KEYS), updated_at)


def profile_of(partials: DataFrame) -> DataFrame:
    """:func:`patterns.location_profile` from partial rows."""
    first = {c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("first_key"))) for c in ("latitude", "longitude")}
    pairs = partials.filter("n > 0 and location is not null").groupBy("location", "road_name").agg(
        *[c.alias(n) for n, c in first.items()],
        F.try_divide(F.sum("severity_sum"), F.sum("severity_n")).alias("severity_score"),
        F.try_divide(F.sum("risk_sum"), F.sum("risk_n")).alias("risk_score"),
        F.sum("n").alias("n"),
    )
    return profile_rows(pairs)
