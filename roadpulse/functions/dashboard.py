"""Scalar helpers of the dashboard queries: text, colours, sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marker of an alert row, and colours and sizes of map points.
ALERT_MARKER = "\N{POLICE CARS REVOLVING LIGHT}"
RISK_COLOURS = ((0.7, "red"), (0.5, "orange"))
RISK_COLOUR_DEFAULT = "green"
SIZES = ((10, "large"), (5, "medium"))
SIZE_DEFAULT = "small"

# Cell rules as (lower bound, bound included, upper bound, colour).
COUNT_RULES = ((10, False, None, "red"), (5, False, None, "yellow"))
DENSITY_RULES = ((80, True, None, "red"), (60, True, 79, "yellow"))


def case(branches: list[tuple[Column, object]], default) -> Column:
    """First branch whose test holds."""
    out = None
    for test, value in branches:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def iff(test: Column, yes, no) -> Column:
    return case([(test, yes)], no)


def strcat(*parts) -> Column:
    """Concatenation in which null counts as the empty text."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def tostring(c: Column) -> Column:
    """Text of a number; whole numbers lose their fraction, null becomes empty."""
    return F.coalesce(F.regexp_replace(c.cast("string"), r"\.0$", ""), F.lit(""))


def format_datetime(ts: Column, layout: str = "HH:mm:ss") -> Column:
    return F.date_format(ts, layout)


def bin_start(ts: Column, width: str = "5 minutes") -> Column:
    """Start of the epoch-aligned bin of a time stamp."""
    return F.window(ts, width)["start"]


def countif(test: Column) -> Column:
    return F.count_if(test)


def percent_of(test: Column) -> Column:
    """Share of rows that pass, in percent."""
    return F.count_if(test) * F.lit(100.0) / F.count(F.lit(1))


def by_threshold(c: Column, steps, default) -> Column:
    return case([(c >= bound, value) for bound, value in steps], default)


def risk_colour(score: Column) -> Column:
    return by_threshold(score, RISK_COLOURS, RISK_COLOUR_DEFAULT)


def size_class(count: Column) -> Column:
    return by_threshold(count, SIZES, SIZE_DEFAULT)


def cell_colour(c: Column, rules) -> Column:
    """Colour of the first rule a value meets; null when it meets none."""
    branches = []
    for lower, included, upper, colour in rules:
        test = (c >= lower) if included else (c > lower)
        if upper is not None:
            test = test & (c <= upper)
        branches.append((test, colour))
    return case(branches, F.lit(None).cast("string"))


def display_level(level: Column) -> Column:
    """Upper-case level; anything but High and Medium shows as LOW."""
    return case([(level == "High", "HIGH"), (level == "Medium", "MEDIUM")], "LOW")


def alert_marker(triggered: Column) -> Column:
    return iff(triggered, ALERT_MARKER, "")
