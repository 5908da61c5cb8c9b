"""Calendar parts, rush hours and cyclic encodings."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO text layout of event times on the wire.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# Rush hours of the accident history and weekend day names.
HISTORY_RUSH_HOURS = (7, 8, 17, 18, 19)
WEEKEND = ("Saturday", "Sunday")


def calendar_parts(ts: Column) -> dict[str, Column]:
    """Date, time and calendar fields of an accident time stamp."""
    return {
        "timestamp": F.date_format(ts, "yyyy-MM-dd HH:mm:ss"),
        "date": F.date_format(ts, "yyyy-MM-dd"),
        "time": F.date_format(ts, "HH:mm:ss"),
        "year": F.year(ts),
        "month": F.month(ts),
        "month_name": F.date_format(ts, "MMMM"),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
        "day_of_week": F.date_format(ts, "EEEE"),
    }


def cyclical(c: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a position in a cycle."""
    angle = c * F.lit(2 * math.pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def is_rush_hour(hour: Column) -> Column:
    """Rush hours as recorded in the accident history."""
    return hour.isin(*HISTORY_RUSH_HOURS)


def is_rush_hour_live(hour: Column) -> Column:
    """Rush hours as used for live scoring: 7 to 9 and 17 to 19, both inclusive."""
    return hour.between(7, 9) | hour.between(17, 19)


def is_weekend(day_name: Column) -> Column:
    return day_name.isin(*WEEKEND)


def parse_iso(text: Column) -> Column:
    """ISO text to timestamp; text that is no time becomes null."""
    return F.try_to_timestamp(text)


def format_iso(ts: Column) -> Column:
    """Timestamp to ISO text with microseconds."""
    return F.date_format(ts, ISO_FORMAT)
