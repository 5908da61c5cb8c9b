"""Order-based operators that stay distributed under skew.

A window without a partition, or one partitioned by a hot key, puts all its rows
into one task. The operators here rank, number and pick rows without that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import uniform01
from ..session import cut_lineage

_PART_SHIFT = 33

# Bits of a row's hash, bits that each pass of a selection fixes, rows that a selection sorts in the end,
# and the most groups whose bounds are sent to every executor.
HASH_BITS = 32
CELL_BITS = 12
CELL_ROWS = 100_000
GROUPS_SENT = 10_000


def as_columns(order: list) -> list[Column]:
    return [c if isinstance(c, Column) else F.col(c) for c in order]


def ordered_parts(df: DataFrame, order: list) -> DataFrame:
    """Split a frame into ranges of the total order.

    Adds ``__part`` (range number, ascending with the order) and ``__pos``
    (position inside the range, from 0). Range bounds are sampled over the full
    order key, so a hot leading value is split as long as the whole key is
    unique. The result is checkpointed: bounds must not move when a lost
    executor makes Spark recompute a part of it.
    """
    cols = as_columns(order)
    spread = df.repartitionByRange(*cols).sortWithinPartitions(*cols)
    numbered = spread.withColumn("__row", F.monotonically_increasing_id())
    split = numbered.withColumns(
        {
            "__part": F.shiftright("__row", _PART_SHIFT),
            "__pos": F.col("__row").bitwiseAND(F.lit((1 << _PART_SHIFT) - 1)),
        }
    ).drop("__row")
    return cut_lineage(split)


def part_offsets(parts: DataFrame) -> DataFrame:
    """Rows before each range. One row per range, so a single window is fine."""
    sizes = parts.groupBy("__part").agg((F.max("__pos") + 1).alias("n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))


def with_sequence(df: DataFrame, order: list, name: str = "id") -> DataFrame:
    """Number all rows 1..n in a total order."""
    parts = ordered_parts(df, order)
    numbered = parts.join(F.broadcast(part_offsets(parts)), "__part")
    return numbered.withColumn(name, F.col("offset") + F.col("__pos") + 1).drop("__part", "__pos", "offset")


def chrono(df: DataFrame, ts: str = "timestamp", tie: str | None = None) -> DataFrame:
    """Time order, ties by a unique column."""
    return df.orderBy(*[c for c in (ts, tie) if c])


def top_n(df: DataFrame, order: list, n: int) -> DataFrame:
    """First ``n`` rows of an order; every task keeps only its own best ``n``."""
    return df.orderBy(*as_columns(order)).limit(n)


def ranked_top(df: DataFrame, order: list, n: int, name: str = "rank") -> DataFrame:
    """Top ``n`` rows with their rank; the window sees only those rows."""
    cols = as_columns(order)
    return top_n(df, order, n).withColumn(name, F.row_number().over(Window.orderBy(*cols)))


def dedup_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first in the given order.

    An aggregate rather than a window, so copies of a hot key shrink to one row
    per task before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("row")
    picked = df.groupBy(*keys).agg(first)
    return picked.select(*[F.col(f"row.{c}").alias(c) if c in rest else F.col(c) for c in df.columns])


def sample_n(df: DataFrame, key: str, n: int, row_key: Column, seed: int = 42) -> DataFrame:
    """At most ``n`` rows per key, drawn by a keyed hash.

    The rank filter lets Spark keep ``n`` rows per key and task ahead of the
    shuffle, so a hot key does not meet in one task.
    """
    w = Window.partitionBy(key).orderBy(uniform01(row_key, f":{seed}"), row_key)
    return df.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= n).drop("__n")


def hash_rank(
    df: DataFrame, group: str, row_key: str, salt: str, name: str = "rank", slices: int = 4096
) -> DataFrame:
    """Rank rows of each group by a keyed hash, however large a group is.

    The hash is cut into equal slices. Rows are ranked inside (group, slice),
    and slices are stacked by their counts: at most ``slices`` rows per group.
    """
    keyed = df.withColumns(
        {
            "__u": uniform01(F.col(row_key), salt),
            "__g": F.coalesce(F.col(group).cast("string"), F.lit("\0")),
        }
    ).withColumn("__slice", F.floor(F.col("__u") * slices))
    sizes = keyed.groupBy("__g", "__slice").agg(F.count(F.lit(1)).alias("__n"))
    stack = Window.partitionBy("__g").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__g",
        "__slice",
        F.coalesce(F.sum("__n").over(stack), F.lit(0)).alias("__before"),
        F.sum("__n").over(Window.partitionBy("__g")).alias("__total"),
    )
    inside = Window.partitionBy("__g", "__slice").orderBy("__u", row_key)
    ranked = keyed.withColumn("__r", F.row_number().over(inside)).join(offsets, ["__g", "__slice"])
    return ranked.withColumns(
        {name: F.col("__before") + F.col("__r"), f"{name}_of": F.col("__total")}
    ).drop("__u", "__g", "__slice", "__before", "__total", "__r")


def share_bounds(df: DataFrame, group: str, row_key: str, salt: str, share: float) -> DataFrame:
    """Group, hash and key of the last row of every group's share in hash order; none for a group whose share rounds to no row.

    Exact selection without ranking: rows are counted by the leading bits of their hash, which names the cell
    that holds the wanted row, and again within that cell, until cells are small. Only (group, key) is read, only counts are shuffled,
    and no more than ``CELL_ROWS`` rows of a group are sorted, unless that many have one hash.
    """
    rows = _hashed(df, group, row_key, salt).select("__g", "__h", F.col(row_key).alias("__k"))
    shift = HASH_BITS - CELL_BITS
    counts = rows.groupBy("__g", F.shiftright("__h", shift).alias("__cell")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("__g"))
    cells, fullest, groups = _wanted_cells(counts.withColumn("take", F.round(total * F.lit(share), 0).cast("long")))
    while shift and fullest > CELL_ROWS:
        inside = _inside(rows, cells, shift).drop("__cell", "n")
        shift = max(0, shift - CELL_BITS)
        counts = inside.groupBy("__g", "take", F.shiftright("__h", shift).alias("__cell")).agg(F.count(F.lit(1)).alias("n"))
        cells, fullest, groups = _wanted_cells(counts)
    order = Window.partitionBy("__g").orderBy("__h", "__k")
    last = _inside(rows, cells, shift).withColumn("__r", F.row_number().over(order)).filter(F.col("__r") == F.col("take"))
    return _sized(last.select("__g", F.col("__h").alias("__to_h"), F.col("__k").alias("__to_k")), groups)


def _hashed(df: DataFrame, group: str, row_key: str, salt: str) -> DataFrame:
    drawn = (uniform01(F.col(row_key), salt) * F.lit(float(1 << HASH_BITS))).cast("long")
    return df.withColumns({"__g": F.coalesce(F.col(group).cast("string"), F.lit("\0")), "__h": drawn})


def _wanted_cells(counts: DataFrame) -> tuple[DataFrame, int, int]:
    """Of cells with ``n`` rows the one that holds row ``take`` of its group, and the place of that row inside it.

    Also the rows of the fullest of these cells, and how many groups there are.
    """
    until = F.sum("n").over(Window.partitionBy("__g").orderBy("__cell").rowsBetween(Window.unboundedPreceding, 0))
    found = counts.withColumn("until", until).filter((F.col("until") >= F.col("take")) & (F.col("until") - F.col("n") < F.col("take")))
    cells = cut_lineage(found.select("__g", "__cell", "n", (F.col("take") - F.col("until") + F.col("n")).alias("take")))
    fullest, groups = cells.agg(F.coalesce(F.max("n"), F.lit(0)), F.count(F.lit(1))).first()
    return _sized(cells, groups), fullest, groups


def _inside(rows: DataFrame, cells: DataFrame, shift: int) -> DataFrame:
    return rows.join(cells, "__g").filter(F.shiftright("__h", shift) == F.col("__cell"))


def _sized(bounds: DataFrame, groups: int) -> DataFrame:
    """One row per group: broadcast up to ``GROUPS_SENT`` of them, else left to the join."""
    return F.broadcast(bounds) if groups <= GROUPS_SENT else bounds


def stratified_split(
    df: DataFrame, label: str, row_key: str, test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Adds ``is_test``: of every label, the rounded share of rows with the smallest hash.

    Whole rows are not moved: each is compared with the bound of its label. Rows of one key go to the same side.
    """
    salt = f":split:{seed}"
    bounds = share_bounds(df, label, row_key, salt, test_share)
    joined = _hashed(df, label, row_key, salt).join(bounds, "__g", "left")
    within = F.struct(F.col("__h"), F.col(row_key)) <= F.struct("__to_h", "__to_k")
    return joined.withColumn("is_test", F.col("__to_h").isNotNull() & within).select(*[F.col(f"`{c}`") for c in df.columns], "is_test")


def assign_folds(df: DataFrame, label: str, row_key: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Adds ``fold`` 0..folds-1, each with an equal share of every label."""
    ranked = hash_rank(df, label, row_key, f":fold:{seed}", "__rank")
    return ranked.withColumn("fold", ((F.col("__rank") - 1) % folds).cast("int")).drop("__rank", "__rank_of")
