"""Mutual information of numbers and classes by nearest neighbours, in sorted ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .features import moments
from .moments import Moments
from .ordering import ordered_parts

# Neighbour that sets the distance, and steps between the extremes of a feature: distances are whole numbers of steps.
NEIGHBOUR = 3
STEPS = 1 << 30


def digamma(n: Column) -> Column:
    """Digamma of a whole number from 1: its asymptotic series ten steps on, and the recurrence back."""
    z = n + 10.0
    back = sum((1.0 / (n + float(j)) for j in range(1, 10)), 1.0 / n)
    return F.log(z) - 0.5 / z - 1 / (12 * z**2) + 1 / (120 * z**4) - 1 / (252 * z**6) - back


def grid_counts(df: DataFrame, columns: list[str], label: str, found: Moments) -> DataFrame:
    """Rows by feature (place in ``columns``), label and grid value ``x``; counted inside tasks first."""
    at = [found.names.index(c) for c in columns]
    codes = []
    for c, lo, hi in zip(columns, found.low[at].tolist(), found.high[at].tolist()):
        codes.append(F.floor((F.col(c) - lo) / (hi - lo) * STEPS + 0.5).cast("long") if lo < hi else F.lit(0).cast("long"))
    rows = df.select(F.col(label).cast("string").alias("label"), F.posexplode(F.array(*codes)).alias("feature", "x"))
    return rows.groupBy("feature", "label", "x").agg(F.count(F.lit(1)).alias("n"))


def with_neighbours(counts: DataFrame, k: int) -> DataFrame:
    """Adds ``near``: (distance, n) of up to ``k`` values of the same feature and label on either side.

    Values are cut into ranges of the total order. The first ``k`` of a range also go to the ``k`` ranges before
    it and its last ``k`` to the ``k`` ranges after it, which is enough even where ranges hold a single row.
    """
    parts = ordered_parts(counts, ["feature", "label", "x"])
    # One row per range.
    ranges = parts.groupBy("__part").agg((F.max("__pos") + 1).alias("rows")).withColumn("at", F.row_number().over(Window.orderBy("__part")))
    rows = parts.join(F.broadcast(ranges), "__part")
    kept = ["feature", "label", "x", "n"]

    def sent(frame: DataFrame, to: Column, own: bool) -> DataFrame:
        return frame.select(*kept, to.alias("to"), F.lit(own).alias("own"))

    at = F.col("at")
    halo = sent(rows.filter(F.col("__pos") < k), F.explode(F.sequence(at - k, at - 1)), False).unionByName(
        sent(rows.filter(F.col("__pos") >= F.col("rows") - k), F.explode(F.sequence(at + 1, at + k)), False)
    )
    w = Window.partitionBy("to").orderBy("feature", "label", "x")
    other = [F.lag(F.struct(*kept), j).over(w) for j in (*range(1, k + 1), *range(-k, 0))]
    seen = sent(rows, at, True).unionByName(halo).select("*", F.array(*other).alias("other"))
    same = F.filter("other", lambda o: (o["feature"] == F.col("feature")) & (o["label"] == F.col("label")))
    near = F.sort_array(F.transform(same, lambda o: F.struct(F.abs(o["x"] - F.col("x")).alias("distance"), o["n"].alias("n"))))
    return seen.filter("own").select(*kept, near.alias("near"))


def kth_distance(k: Column) -> Column:
    """Distance of the ``k``-th other row of the same label: rows of the same value first, then those of ``near``."""
    start = F.struct((F.col("n") - 1).alias("seen"), F.when(F.col("n") > k, F.lit(0).cast("long")).alias("d"))

    def step(acc: Column, item: Column) -> Column:
        seen = acc["seen"] + item["n"]
        return F.struct(seen.alias("seen"), F.coalesce(acc["d"], F.when(seen >= k, item["distance"])).alias("d"))

    return F.aggregate("near", start, step, lambda acc: acc["d"])


def rows_within(points: DataFrame) -> DataFrame:
    """Adds ``m``, the rows of a feature, whatever their label, that are no further than ``e`` from a point.

    The difference of two prefix sums of the counts: the bounds of all points are sorted among the values, summed
    inside ranges, and ranges are stacked by their totals.
    """
    x, e = F.col("x"), F.col("e")
    zero = F.lit(0).cast("long")
    places = F.array(
        F.struct(x.alias("t"), F.lit(0).alias("sign"), F.col("n").alias("weight")),
        F.struct((x + e).alias("t"), F.lit(1).alias("sign"), zero.alias("weight")),
        F.struct((x - e - 1).alias("t"), F.lit(-1).alias("sign"), zero.alias("weight")),
    )
    laid = points.select("*", F.inline(places)).withColumn("asks", F.col("sign") != 0)
    parts = ordered_parts(laid, ["feature", "t", "asks", "label", "x", "sign"])
    # One row per range.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = parts.groupBy("__part").agg(F.sum("weight").alias("total"))
    ranges = ranges.select("__part", F.coalesce(F.sum("total").over(before), zero).alias("before"))
    inside = Window.partitionBy("__part").orderBy("__pos").rowsBetween(Window.unboundedPreceding, 0)
    summed = parts.withColumn("upto", F.sum("weight").over(inside)).filter("asks").join(F.broadcast(ranges), "__part")
    return summed.groupBy(*points.columns).agg(F.sum(F.col("sign") * (F.col("before") + F.col("upto"))).alias("m"))


def mutual_info_knn(df: DataFrame, columns: list[str], label: str, k: int = NEIGHBOUR, found: Moments | None = None) -> DataFrame:
    """Mutual information of features and label, in nats, from distances to the ``k``-th neighbour of the same label.

    A row whose ``k``-th such neighbour lies at a distance d counts the rows of any label nearer than d, itself
    included. Where d is 0 the rows of its value count instead, those of its label against all, itself left out, so that
    features of few values give the plug-in estimate but for a small term. A label of fewer than ``k`` + 1 rows takes
    all its other rows; rows of a label that no other row has are left out, as are null labels. Features
    must not be null. Values are compared in ``STEPS`` between a feature's extremes, which come from ``found``,
    the table's moments, if these are known already.
    """
    found = found or moments(df, columns)
    # One row per label.
    sizes = df.groupBy(F.col(label).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("size")).filter("label IS NOT NULL AND size > 1")
    sizes = F.broadcast(sizes.withColumn("total", F.sum("size").over(Window.partitionBy())))
    counts = grid_counts(df, columns, label, found).join(sizes.select("label"), "label", "left_semi")
    least = F.least(F.lit(k), F.col("size") - 1)
    points = with_neighbours(counts, k).join(sizes, "label").withColumn("d", kth_distance(least))
    asked = points.withColumn("e", F.greatest(F.col("d") - 1, F.lit(0))).drop("near")
    tied = F.col("d") == 0
    psi = F.when(tied, digamma(F.col("n") - 1) - digamma(F.col("m") - 1)).otherwise(digamma(least) - digamma(F.col("m")))
    terms = rows_within(asked).withColumn("term", F.col("n") * (psi - digamma(F.col("size"))))
    names = F.array(*[F.lit(c) for c in columns])
    score = F.sum("term") / F.first("total") + digamma(F.first("total"))
    return terms.groupBy("feature").agg(F.greatest(score, F.lit(0.0)).alias("score")).select(
        F.element_at(names, F.col("feature") + 1).alias("feature"), "score"
    )
