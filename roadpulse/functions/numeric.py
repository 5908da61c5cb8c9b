"""Rounding, clipping and keyed draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(c: Column, digits: int) -> Column:
    """Half-up rounding that does not depend on the binary form of the number; wide enough for sums over any table."""
    return F.round(c.cast("decimal(38,8)"), digits).cast("double")


def clip(c: Column, lo=None, hi=None) -> Column:
    """Bound a column; null stays null, which least and greatest alone would not keep."""
    out = c
    if hi is not None:
        out = F.least(out, F.lit(hi))
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    return F.when(c.isNotNull(), out)


def uniform01(key: Column, salt: str = "") -> Column:
    """Draw from [0, 1) fixed by the key: the same on every run and every engine."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def between_draw(key: Column, salt: str, lo: float, hi: float) -> Column:
    """Keyed draw from [lo, hi)."""
    return F.lit(lo) + uniform01(key, salt) * F.lit(hi - lo)
