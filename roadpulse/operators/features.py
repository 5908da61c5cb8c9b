"""Feature building and feature statistics for the risk-level model."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .moments import Moments, moments_by, whole
from .ordering import top_n

# Encoded columns, the candidate features in order, and the text
# that stands for a missing category.
CATEGORICAL = ("day_of_week", "weather", "road_type", "road_surface")
CANDIDATES = (
    "hour", "hour_sin", "hour_cos",
    "day_of_week_encoded", "day_sin", "day_cos",
    "month", "month_sin", "month_cos",
    "is_weekend", "is_rush_hour", "is_holiday",
    "latitude", "longitude",
    "road_type_encoded", "speed_limit", "lanes",
    "base_location_risk",
    "weather_encoded", "temperature", "precipitation",
    "cloudcover", "windspeed", "road_surface_encoded",
    "traffic_density", "average_speed",
    "time_risk_factor", "weather_risk_factor", "day_risk_factor",
)
MISSING_CATEGORY = "None"

# Cycle length of the cyclic features and their source column.
CYCLES = {"hour": ("hour", 24), "month": ("month", 12), "day": ("day_of_week_encoded", 7)}

# Limits of the multicollinearity reports, the value reported for
# an infinite inflation factor, and the number of selected features.
VIF_LIMIT = 10.0
VIF_INFINITE = 999.0
PAIR_LIMIT = 0.8
PRUNE_LIMIT = 0.9
PAIRS_SHOWN = 10
SELECTED = 20
BINS = 10
EDGE_SLACK = 1e-9


@dataclass
class Profile:
    """What one pass over accident rows gives: the features' moments per label, the categories and the means that fill gaps."""

    names: list[str]
    classes: dict[str | None, Moments]
    categories: dict[str, list[str]]
    means: dict[str, float]

    def whole(self) -> Moments:
        return whole(self.classes, self.names)


def category_text(columns=CATEGORICAL) -> SQLTransformer:
    texts = ", ".join(f"coalesce(cast({c} AS string), '{MISSING_CATEGORY}') AS {c}_text" for c in columns)
    return SQLTransformer(statement=f"SELECT *, {texts} FROM __THIS__")


def label_indexers(columns=CATEGORICAL) -> list:
    """Stages that number the sorted classes of text columns from 0.

    A missing value is a class of its own; a value unseen in training lands in
    an extra bucket that :func:`known_codes` maps to 0.
    """
    indexer = StringIndexer(
        inputCols=[f"{c}_text" for c in columns],
        outputCols=[f"{c}_code" for c in columns],
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    )
    return [category_text(columns), indexer]


def known_codes(indexer, columns=CATEGORICAL) -> SQLTransformer:
    """Codes as ``<column>_encoded``, with unseen values as 0."""
    codes = ", ".join(
        f"if({c}_code >= {len(labels)}, 0D, {c}_code) AS {c}_encoded"
        for c, labels in zip(columns, indexer.labelsArray)
    )
    return SQLTransformer(statement=f"SELECT *, {codes} FROM __THIS__")


def cycle_stage() -> SQLTransformer:
    parts = [
        f"{fn}(2 * pi() * {source} / {period}) AS {name}_{fn}"
        for name, (source, period) in CYCLES.items()
        for fn in ("sin", "cos")
    ]
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def cycle_columns() -> dict[str, tuple[str, str, int]]:
    """Cyclical features: function, source column and period of each."""
    return {f"{name}_{fn}": (fn, source, period) for name, (source, period) in CYCLES.items() for fn in ("sin", "cos")}


def profile(df: DataFrame, names=CANDIDATES, label: str | None = None) -> Profile:
    """Moments of the candidate features of accident rows by ``label``, in one job.

    Codes of categories and what is made of them need no second pass: they are linear in the categories' indicators. A
    feature with missing values counts as filled with its mean; one without any value is 0.
    """
    names, cycles = list(names), cycle_columns()
    codes = {f"{c}_encoded": c for c in CATEGORICAL}
    of_code = {n: codes.get(cycles[n][1] if n in cycles else n) for n in names}
    plain = [n for n in names if not of_code[n]]
    waves = {n: F.expr(f"{fn}(2 * pi() * {source} / {period})") for n, (fn, source, period) in cycles.items() if n in plain}
    raw = moments_by(df.withColumns(waves) if waves else df, plain, label, CATEGORICAL, MISSING_CATEGORY)
    every = whole(raw, plain)
    categories = {c: every.categories().get(c, []) for c in CATEGORICAL}
    means = {n: every.present_mean(n) for n in plain}
    coded = {}
    for name, column in of_code.items():
        if column:
            turn = (lambda k: float(k)) if name in codes else _wave(*cycles[name])
            coded[name] = (column, {v: turn(k) for k, v in enumerate(categories[column])})
    return Profile(names, {c: m.mapped(means, coded, names) for c, m in raw.items()}, categories, means)


def _wave(fn: str, source: str, period: int):
    return lambda k: getattr(math, fn)(2 * math.pi * k / period)


def fit_stages(df: DataFrame, names=CANDIDATES, found: Profile | None = None) -> list:
    """Fitted stages from accident rows to a ``features`` vector in ``names`` order.

    All that is fitted, categories and column means, comes from the profile of the rows, which is made
    here unless it is given. The feature list travels inside the assembler.
    """
    found = found or profile(df, names)
    indexed = StringIndexerModel.from_arrays_of_labels(
        [found.categories[c] for c in CATEGORICAL], [f"{c}_text" for c in CATEGORICAL], [f"{c}_code" for c in CATEGORICAL], "keep"
    )
    casts = ", ".join(f"cast({n} AS double) AS f_{n}" for n in names)
    filled = ", ".join(
        f"coalesce(nullif(f_{n}, double('NaN')), double('{found.means[n]!r}')) AS x_{n}" if n in found.means else f"f_{n} AS x_{n}"
        for n in names
    )
    return [
        category_text(), indexed, known_codes(indexed), cycle_stage(),
        SQLTransformer(statement=f"SELECT *, {casts} FROM __THIS__"),
        SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"),
        VectorAssembler(inputCols=[f"x_{n}" for n in names], outputCol="features"),
    ]


def mean_impute(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null replaced by the column mean, which one aggregate pass provides."""
    means = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(means[c])) for c in columns})


def feature_names(model: PipelineModel) -> list[str]:
    """Feature list of a fitted pipeline, in vector order."""
    for stage in model.stages:
        if isinstance(stage, VectorAssembler):
            return [c.removeprefix("x_") for c in stage.getInputCols()]
    raise ValueError("the pipeline has no assembler")


def candidate_features(df: DataFrame, keep=("id", "risk_level"), names=CANDIDATES, found: Profile | None = None) -> DataFrame:
    """The features as double columns, imputed, next to the kept columns."""
    ready = PipelineModel(fit_stages(df, names, found)[:-1]).transform(df)
    return ready.select(*keep, *[F.col(f"x_{n}").alias(n) for n in names])


def moments(df: DataFrame, columns: list[str]) -> Moments:
    """Moments of numeric columns in one job. A row counts with its missing values filled by the column's mean."""
    every = whole(moments_by(df, columns), columns)
    return every.mapped({c: every.present_mean(c) for c in columns}, {}, list(columns))


def corr_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every ordered pair of columns, null where one is constant."""
    return corr_of(df.sparkSession, moments(df, columns))


def corr_of(spark: SparkSession, found: Moments) -> DataFrame:
    """:func:`corr_matrix` of a table whose moments are known."""
    matrix = found.correlations()
    rows = [
        (i, j, a, b, None if np.isnan(matrix[i, j]) else float(matrix[i, j]))
        for i, a in enumerate(found.names)
        for j, b in enumerate(found.names)
    ]
    return spark.createDataFrame(rows, "pos_a int, pos_b int, feature_a string, feature_b string, r double")


def corr_pairs(corr: DataFrame, limit: float = PAIR_LIMIT, k: int = PAIRS_SHOWN) -> DataFrame:
    """Strongest pairs above the limit, each pair once."""
    pairs = corr.filter((F.col("pos_a") < F.col("pos_b")) & (F.abs("r") > limit))
    order = [F.desc(F.abs("r")), F.asc("pos_a"), F.asc("pos_b")]
    return top_n(pairs, order, k).select("feature_a", "feature_b", "r")


def corr_prune(corr: DataFrame, limit: float = PRUNE_LIMIT) -> tuple[list[str], list[str]]:
    """Kept and dropped features: a feature goes when any earlier one correlates above the limit."""
    flagged = corr.groupBy("pos_b", "feature_b").agg(
        F.max((F.col("pos_a") < F.col("pos_b")) & (F.abs("r") > limit)).alias("drop")
    )
    rows = flagged.orderBy("pos_b").collect()
    return [r["feature_b"] for r in rows if not r["drop"]], [r["feature_b"] for r in rows if r["drop"]]


def vif(df: DataFrame, columns: list[str]) -> DataFrame:
    """Variance inflation factor of every column against the others, worst first.

    Regressions without intercept, solved from the Gram matrix that the moments
    give. Where the other columns span a constant the centred form applies.
    """
    return vif_of(df.sparkSession, moments(df, columns))


def vif_of(spark: SparkSession, found: Moments) -> DataFrame:
    """:func:`vif` of a table whose moments are known."""
    count, mean = found.count, found.mean
    varies = found.deviations() > 1e-12 * np.abs(mean)
    cov = found.spread * np.outer(varies, varies)
    gram = cov + count * np.outer(mean, mean)
    rows = []
    for i, name in enumerate(found.names):
        others = [j for j in range(len(found.names)) if j != i]
        rows.append((name, _inflation(gram, cov, mean, count, i, others)))
    out = spark.createDataFrame(rows, "feature string, vif double")
    return out.orderBy(F.desc("vif"), F.asc("feature"))


def _inflation(gram, cov, mean, count, i, others) -> float:
    """Total over residual sum of squares of column ``i`` given the others."""
    inner = gram[np.ix_(others, others)]
    scale = np.sqrt(np.diag(inner))
    scale[scale == 0] = 1.0
    inverse = np.linalg.pinv(inner / np.outer(scale, scale), rcond=1e-12, hermitian=True)
    ones = count * mean[others] / scale
    spans_constant = count - ones @ inverse @ ones <= 1e-9 * count
    total = cov[i, i] if spans_constant else gram[i, i]
    cross = gram[i, others] / scale
    residual = gram[i, i] - cross @ inverse @ cross
    if total <= 0 or residual <= 1e-10 * gram[i, i]:
        return VIF_INFINITE
    return float(total / residual)


def high_vif(frame: DataFrame, limit: float = VIF_LIMIT) -> DataFrame:
    return frame.filter(F.col("vif") > limit)


def anova_f(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """F statistic of every feature between the label classes; a constant feature has none."""
    return anova_of(df.sparkSession, moments_by(df, columns, label), columns)


def anova_of(spark: SparkSession, classes: dict[str | None, Moments], columns: list[str]) -> DataFrame:
    """:func:`anova_f` of a table whose moments by class are known."""
    columns = list(columns)
    every = whole(classes, columns)
    fills = {c: every.present_mean(c) for c in columns}
    parts = [m.mapped(fills, {}, columns) for m in classes.values()]
    every = every.mapped(fills, {}, columns)
    between = sum((p.count * (p.mean - every.mean) ** 2 for p in parts), np.zeros(len(columns)))
    within = sum((np.diag(p.spread) for p in parts), np.zeros(len(columns)))
    free, left = len(parts) - 1, every.count - len(parts)
    scores = [
        float(b / free / (w / left)) if lo < hi and free > 0 and left > 0 and w > 0 else None
        for b, w, lo, hi in zip(between, within, every.low, every.high)
    ]
    return spark.createDataFrame(list(zip(columns, scores)), "feature string, score double")


def mutual_info(df: DataFrame, columns: list[str], label: str, bins: int = BINS, found: Moments | None = None) -> DataFrame:
    """Mutual information of binned features and label, in nats.

    Features are cut into equal-width bins between their extremes. Counts by
    (feature, bin, label) are combined inside each task, so the shuffle carries
    at most features x bins x labels rows per task. The extremes come from ``found``, the table's
    moments, if these are known already.
    """
    found = found or moments(df, columns)
    at = [found.names.index(c) for c in columns]
    codes = []
    for i, (c, lo, hi) in enumerate(zip(columns, found.low[at].tolist(), found.high[at].tolist())):
        code = F.lit(i * bins)
        if lo < hi:
            # The small addend keeps a value on a bin edge from falling below it.
            place = F.floor((F.col(c) - lo) / (hi - lo) * bins + EDGE_SLACK).cast("int")
            code = code + F.least(place, F.lit(bins - 1))
        codes.append(code)
    # Feature and bin share one number, so the exploded rows stay small.
    counted = (
        df.select(F.col(label).alias("label"), F.explode(F.array(*codes)).alias("code"))
        .groupBy("code", "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    names = F.array(*[F.lit(c) for c in columns])
    cells = counted.select(
        F.element_at(names, F.floor(F.col("code") / bins).cast("int") + 1).alias("feature"),
        F.pmod("code", F.lit(bins)).alias("bin"), "label", "n",
    )
    # From here on there is one row per feature, bin and label.
    per_bin = F.sum("n").over(Window.partitionBy("feature", "bin"))
    per_label = F.sum("n").over(Window.partitionBy("feature", "label"))
    total = F.sum("n").over(Window.partitionBy("feature"))
    n = F.col("n")
    terms = cells.withColumn("term", n / total * F.log(n * total / (per_bin * per_label)))
    return terms.groupBy("feature").agg(F.greatest(F.sum("term"), F.lit(0.0)).alias("score"))


def top_features(scores: DataFrame, k: int = SELECTED) -> DataFrame:
    """Best features by score; ties by name."""
    return top_n(scores, [F.desc_nulls_last("score"), F.asc("feature")], k)
