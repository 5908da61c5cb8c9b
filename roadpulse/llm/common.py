"""What several text operators share: whitespace, row keys, stored intermediate tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# Whitespace of all text contracts: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = ("\t", "\n", "\x0b", "\x0c", "\r")


# Columns of a numbered table: the key of the row, and the whole row as it was.
ROW, WHOLE = "__rid", "__row"


def numbered(docs: DataFrame) -> DataFrame:
    """Two columns, the key of each row in ``ROW`` and the row itself in ``WHOLE``, written once.

    Two scans of a table may be split differently, as executors come and go, so that keys drawn
    in each do not agree. Whatever reads a table again to join it takes this one. The row is one
    column, so that no name in it is taken for the key.
    """
    return stored(docs.select(F.monotonically_increasing_id().alias(ROW), F.struct("*").alias(WHOLE)), "numbered")


def with_row_key(docs: DataFrame, *columns: Column | str) -> DataFrame:
    """The columns asked for, behind ``rid``, a key of the row: that of a numbered table, else drawn.

    Repeated, equal or null ids thus stay apart. A drawn key is good for one scan. ``docs`` has to be a
    table scan (as all queries and pipeline stages pass): then a lost task numbers its rows as before.
    """
    if docs.columns != [ROW, WHOLE]:
        return docs.select(F.monotonically_increasing_id().alias("rid"), *columns)
    taken, name = {f.name.lower() for f in docs.schema[WHOLE].dataType}, "key"
    while name in taken:
        name += "_"
    return docs.select(F.col(ROW).alias(name), f"{WHOLE}.*").select(F.col(name).alias("rid"), *columns)


def rows_kept(docs: DataFrame, stay: DataFrame) -> DataFrame:
    """Rows of a numbered table whose key is in ``stay`` (rid), as they were."""
    return docs.join(stay.select(F.col("rid").alias(ROW)), ROW, "left_semi").select(f"{WHOLE}.*")


def whole_text(name: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def one_spaced(text: Column) -> Column:
    """Each run of whitespace as one space.

    Plain replacement does most texts without the regular expression.
    """
    spaced = reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(" ")), SPACES, text)
    return F.when(F.contains(spaced, F.lit("  ")), F.regexp_replace(spaced, " {2,}", " ")).otherwise(spaced)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, even where ``body`` uses it inside a lambda.

    The optimizer would copy a column's expression into the lambda and run it for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


# Tables that ``stored`` writes while a stage runs, see ``stage``.
_made: list[list[str]] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: later stages do not hang on executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    for made in _made:
        made.append(path)
    return spark.read.parquet(path)


def stage(run: Callable) -> Callable:
    """A pipeline stage (spark, docs, sf_dir) whose own tables go when the next stage on the same ``sf_dir`` begins.

    By then its result is written, as each stage gets the written result of the one before.
    """

    @wraps(run)
    def staged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for path in _of_stage.pop(sf_dir, []):
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        made: list[str] = []
        _made.append(made)
        try:
            return run(spark, docs, sf_dir)
        finally:
            _made.remove(made)
            _of_stage[sf_dir] = made

    return staged


_of_stage: dict[str, list[str]] = {}
