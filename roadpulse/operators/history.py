"""Accident history: dimension joins, risk scores, table profile, as-of weather."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import calendar_parts, is_rush_hour, is_weekend
from ..functions.numeric import rounded
from ..functions.risk import (
    HISTORY_LEVELS, density_estimate, pick, risk_level, risk_score, severity_probabilities, speed_estimate,
)
from ..functions.text import primary_cause
from ..schemas import ACCIDENT_SCHEMA, conform
from ..sources import dims
from .ordering import ordered_parts

WEATHER_FIELDS = (
    "temperature", "precipitation", "cloudcover", "windspeed", "visibility", "weather", "road_surface",
)

# How long an observation counts as current, in seconds.
WEATHER_MAX_AGE = 300
# Windows over which the events of one slot of time are dealt.
ASOF_SALTS = 16


def with_calendar(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Calendar columns and the flags that depend on the calendar alone."""
    parts = calendar_parts(F.col(ts))
    return df.withColumns(parts).withColumns(
        {"is_weekend": is_weekend(F.col("day_of_week")), "is_rush_hour": is_rush_hour(F.col("hour"))}
    )


def with_risk_factors(df: DataFrame, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """Hour, weekday and weather factors, 1.0 where a value is unknown.

    The fixed factors are column expressions, which cost nothing in queries that
    do not use them. Factor tables of one's own, keyed ``hour``, ``day_of_week``
    and ``weather`` with a ``factor`` column, are joined.
    """
    if tables is not None:
        return _joined_factors(df, tables)
    hour = F.get(F.array(*[F.lit(v) for v in dims.HOUR_FACTORS]), F.col("hour"))
    return df.withColumns(
        {
            "time_risk_factor": F.coalesce(hour, F.lit(1.0)),
            "day_risk_factor": pick(F.col("day_of_week"), dims.DAY_FACTORS, 1.0),
            "weather_risk_factor": pick(F.col("weather"), dims.WEATHER_FACTORS, 1.0),
        }
    )


FACTOR_KEYS = {"hour": "time_risk_factor", "day_of_week": "day_risk_factor", "weather": "weather_risk_factor"}


def factor_tables(spark) -> dict[str, DataFrame]:
    """The fixed factors as tables."""
    return {
        "hour": dims.hour_factors(spark).withColumnRenamed("time_factor", "factor"),
        "day_of_week": dims.day_factors(spark).withColumnRenamed("day_factor", "factor"),
        "weather": dims.weather_factors(spark).withColumnRenamed("weather_factor", "factor"),
    }


def _joined_factors(df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    out = df
    for key, name in FACTOR_KEYS.items():
        side = tables[key].select(F.col(key).alias("__k"), F.col("factor").alias(f"__{name}"))
        out = out.join(side, F.col(key) == F.col("__k"), "left").drop("__k")
    filled = {n: F.coalesce(F.col(f"__{n}"), F.lit(1.0)) for n in FACTOR_KEYS.values()}
    return out.withColumns(filled).select(*df.columns, *filled)


def with_holiday(df: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Flag dates of the fixed holiday list, or of a holiday table, which is joined."""
    if holidays is None:
        return df.withColumn("is_holiday", F.col("date").isin(*dims.HOLIDAYS))
    days = holidays.select(F.col("date").alias("__holiday")).distinct()
    joined = df.join(days, F.col("date") == F.col("__holiday"), "left")
    return joined.withColumn("is_holiday", F.col("__holiday").isNotNull()).drop("__holiday")


def with_weather(df: DataFrame, weather_day: DataFrame) -> DataFrame:
    """Daily weather of every row; dates without it take the default of their month.

    One row per date: the side is broadcast after its row count is checked, and
    joined by shuffle beyond the bound.
    """
    defaults = dims.season_defaults(df.sparkSession)
    day = weather_day.select(
        F.col("date").alias("__date"), *[F.col(c).alias(f"__w_{c}") for c in WEATHER_FIELDS]
    )
    month = defaults.select(
        F.col("month").alias("__month"), *[F.col(c).alias(f"__d_{c}") for c in WEATHER_FIELDS]
    )
    joined = df.join(day, F.col("date") == F.col("__date"), "left").join(
        F.broadcast(month), F.month(F.to_date("date")) == F.col("__month"), "left"
    )
    known = F.col("__date").isNotNull()
    picked = {c: F.when(known, F.col(f"__w_{c}")).otherwise(F.col(f"__d_{c}")) for c in WEATHER_FIELDS}
    keep = [c for c in df.columns if c not in WEATHER_FIELDS]
    return joined.withColumns(picked).select(*keep, *WEATHER_FIELDS)


def with_risk(df: DataFrame, base: str = "base_risk") -> DataFrame:
    """Score and level from base risk, factors and holiday.

    The level uses the unrounded score, the stored score has three decimals.
    """
    score = risk_score(
        F.col(base), F.col("time_risk_factor"), F.col("day_risk_factor"),
        F.col("weather_risk_factor"), F.col("is_holiday"),
    )
    return df.withColumn("__score", score).withColumns(
        {
            "risk_score": rounded(F.col("__score"), 3),
            "risk_level": risk_level(F.col("__score"), *HISTORY_LEVELS),
            "base_location_risk": rounded(F.col(base), 3),
        }
    ).withColumnRenamed("__score", "raw_risk_score")


def enrich_accidents(
    facts: DataFrame, roads: DataFrame, weather_day: DataFrame, noise: Column | int = 0
) -> DataFrame:
    """Accident facts to the accident table in one plan.

    ``facts`` has accident_id, id, ts, location, road_name, severity,
    accident_type, casualties and vehicles_involved. ``roads`` is the calibrated
    road database, unique per (road_name, location).
    """
    place = roads.select(
        "road_name", "location", "road_group", "latitude", "longitude", "road_type", "lanes",
        "speed_limit", "base_risk",
    )
    placed = facts.join(place, ["road_name", "location"])
    scored = with_risk(with_risk_factors(with_holiday(with_weather(with_calendar(placed), weather_day))))
    density = density_estimate(F.col("raw_risk_score"), noise)
    cause = primary_cause(F.col("weather"), F.col("hour"), F.col("accident_type"), F.col("day_of_week"))
    full = scored.withColumns({"traffic_density": density, "primary_cause": cause}).withColumn(
        "average_speed", speed_estimate(F.col("speed_limit"), F.col("traffic_density"), noise)
    )
    return conform(full, ACCIDENT_SCHEMA)


def severity_mix(df: DataFrame, score: str = "risk_score") -> DataFrame:
    """Severity probabilities of every row."""
    p = severity_probabilities(F.col(score))
    return df.withColumns({f"p_{k}": p[k] for k in ("fatal", "serious", "minor")})


def accident_type_mix(df: DataFrame) -> DataFrame:
    """Expected number of accidents by road and accident type, from the road type shares."""
    per_road = df.groupBy("road_name", "road_type").agg(F.count(F.lit(1)).alias("n"))
    mix = F.broadcast(dims.accident_types(df.sparkSession))
    return per_road.join(mix, "road_type").groupBy("road_name", "accident_type").agg(
        F.sum(F.col("n") * F.col("share")).alias("expected")
    )


def expected_weather(df: DataFrame) -> DataFrame:
    """Expected number of accidents by month and weather, from the seasonal shares."""
    per_month = df.groupBy("month").agg(F.count(F.lit(1)).alias("n"))
    shares = F.broadcast(dims.season_weather(df.sparkSession))
    return per_month.join(shares, "month").select(
        "month", "season", "weather", (F.col("n") * F.col("share")).alias("expected")
    )


def profile(df: DataFrame, date: str = "date", road: str = "road_name", flags: dict | None = None) -> DataFrame:
    """One row about a table: rows, columns, roads, dates, and counts of given conditions.

    Roads are counted from a pre-aggregate by road, so the distinct count does
    not spread every row.
    """
    counted = {k: F.count_if(v) for k, v in (flags or {}).items()}
    per_road = df.groupBy(road).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(F.to_date(date)).alias("first"), F.max(F.to_date(date)).alias("last"),
        *[c.alias(k) for k, c in counted.items()],
    )
    return per_road.agg(
        F.sum("rows").alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        F.count(road).alias("road_count"),
        F.date_format(F.min("first"), "yyyy-MM-dd").alias("first_date"),
        F.date_format(F.max("last"), "yyyy-MM-dd").alias("last_date"),
        (F.datediff(F.max("last"), F.min("first")) + 1).alias("days_covered"),
        *[F.sum(k).alias(k) for k in counted],
    )


def one_per_instant(observations: DataFrame) -> DataFrame:
    """(obs_ts, obs): of several observations of one instant the one with the smallest payload."""
    payload = [c for c in observations.columns if c != "obs_ts"]
    return observations.groupBy("obs_ts").agg(F.min(F.struct(*payload)).alias("obs"))


def weather_asof(
    events: DataFrame,
    observations: DataFrame,
    max_age: int = WEATHER_MAX_AGE,
    event_ts: str = "Timestamp",
    event_key: str = "EventId",
    salts: int = ASOF_SALTS,
) -> DataFrame:
    """Last observation at or before every event that is younger than ``max_age`` seconds.

    ``observations`` has obs_ts and payload columns; adds obs_ts and the payload,
    null when nothing is current. Time is cut into slots of ``max_age``: an
    observation is current in its own slot and the next one only, so one window per
    slot carries the last one on. Events of a slot are dealt over ``salts`` windows,
    and the observations, which are few beside the events, go to each of them.
    """
    width = max_age * 10**6
    slot = lambda c: F.floor(F.unix_micros(c) / width)
    single = one_per_instant(observations)
    spread = single.select(
        "obs_ts", "obs", F.explode(F.sequence(slot(F.col("obs_ts")), slot(F.col("obs_ts")) + 1)).alias("__slot")
    ).select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__salt"))
    kind = single.schema
    both = events.select(
        slot(F.col(event_ts)).alias("__slot"), F.pmod(F.xxhash64(event_key), F.lit(salts)).cast("int").alias("__salt"),
        F.col(event_ts).alias("__ts"), F.lit(1).alias("__kind"), F.struct(*events.columns).alias("event"),
        F.lit(None).cast(kind["obs_ts"].dataType).alias("obs_ts"), F.lit(None).cast(kind["obs"].dataType).alias("obs"),
    ).unionByName(
        spread.select(
            "__slot", "__salt", F.col("obs_ts").alias("__ts"), F.lit(0).alias("__kind"),
            F.lit(None).cast(events.schema).alias("event"), "obs_ts", "obs",
        )
    )
    order = Window.partitionBy("__slot", "__salt").orderBy("__ts", "__kind")
    seen = F.when(F.col("obs_ts").isNotNull(), F.struct("obs_ts", "obs"))
    latest = both.withColumn("seen", F.last(seen, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return _current(latest.filter("__kind = 1"), F.col("seen"), max_age, single)


def _current(rows: DataFrame, latest: Column, max_age: int, single: DataFrame) -> DataFrame:
    """Events with the payload of their last observation where that is young enough."""
    fresh = F.col("__ts") < latest["obs_ts"] + F.expr(f"INTERVAL {max_age} SECONDS")
    payload = single.schema["obs"].dataType.names
    return rows.select(
        "event.*", F.when(fresh, latest["obs_ts"]).alias("obs_ts"), *[F.when(fresh, latest["obs"][c]).alias(c) for c in payload]
    )


def weather_asof_ordered(
    events: DataFrame,
    observations: DataFrame,
    max_age: int = WEATHER_MAX_AGE,
    event_ts: str = "Timestamp",
    event_key: str = "EventId",
) -> DataFrame:
    """The same rows as :func:`weather_asof` for times so uneven that salted slots do not balance them.

    Events and observations are ordered together and the last observation is carried
    on. Ranges of the order are balanced whatever the times are, and the last
    observation before each range comes from one row per range.
    """
    single = one_per_instant(observations)
    row = F.struct(*events.columns)
    both = events.select(
        F.col(event_ts).alias("__ts"), F.lit(1).alias("__kind"), F.col(event_key).cast("string").alias("__key"),
        row.alias("event"), F.lit(None).cast(single.schema["obs_ts"].dataType).alias("obs_ts"),
        F.lit(None).cast(single.schema["obs"].dataType).alias("obs"),
    ).unionByName(
        single.select(
            F.col("obs_ts").alias("__ts"), F.lit(0).alias("__kind"), F.lit("").alias("__key"),
            F.lit(None).cast(events.schema).alias("event"), "obs_ts", "obs",
        )
    )
    parts = ordered_parts(both, ["__ts", "__kind", "__key"])
    seen = F.when(F.col("obs_ts").isNotNull(), F.struct("obs_ts", "obs"))
    inside = Window.partitionBy("__part").orderBy("__pos")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        parts.groupBy("__part")
        .agg(F.max_by(seen, F.when(seen.isNotNull(), F.col("__pos"))).alias("last"))
        .select("__part", F.last("last", ignorenulls=True).over(before).alias("carry"))
    )
    current = parts.withColumn("seen", F.last(seen, ignorenulls=True).over(inside)).join(
        F.broadcast(carried), "__part"
    )
    latest = F.coalesce("seen", "carry")
    return _current(current.filter(F.col("__kind") == 1), latest, max_age, single)
