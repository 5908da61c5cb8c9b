"""Count, means, co-moments, extremes and categories of a table per class, in one pass.

Every task reduces its rows to one partial result per class, which holds square matrices of the column
count, never rows. Partial results are merged pairwise, in Spark for each of ``SLOTS`` groups of tasks,
so at most that many per class reach the driver, however large the table is.

A category column enters as one indicator per value and a column with missing values as its value (0
where missing) and an indicator of the missing ones. Whatever is a function of a category, or filled in
where missing, is thus a linear map of the columns; its moments follow without another pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 32
PARTIAL = "label string, n long, names array<string>, mean array<double>, spread array<double>, low array<double>, high array<double>"
_MISSING, _VALUE = "\0?", "\0="


@dataclass
class Moments:
    """Of ``count`` rows: means, sums of products of deviations (``spread``) and extremes of named columns."""

    names: list[str]
    count: int
    mean: np.ndarray
    spread: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def aligned(self, names: list[str]) -> Moments:
        """With further columns, which are 0 in all rows."""
        if names == self.names:
            return self
        place = {n: i for i, n in enumerate(names)}
        at = [place[n] for n in self.names]
        mean, low, high, spread = np.zeros(len(names)), np.zeros(len(names)), np.zeros(len(names)), np.zeros((len(names),) * 2)
        mean[at], low[at], high[at], spread[np.ix_(at, at)] = self.mean, self.low, self.high, self.spread
        return Moments(names, self.count, mean, spread, low, high)

    def merged(self, other: Moments) -> Moments:
        """Of both sets of rows."""
        seen = set(self.names)
        names = self.names + [n for n in other.names if n not in seen]
        a, b = self.aligned(names), other.aligned(names)
        n = a.count + b.count
        if not n:
            return a
        gap = b.mean - a.mean
        spread = a.spread + b.spread + np.outer(gap, gap) * (a.count * b.count / n)
        return Moments(names, n, a.mean + gap * (b.count / n), spread, np.minimum(a.low, b.low), np.maximum(a.high, b.high))

    def deviations(self) -> np.ndarray:
        """Sample deviations; exactly 0 for a column of one value."""
        return np.where(self.low < self.high, np.sqrt(np.clip(np.diag(self.spread), 0, None) / max(self.count - 1, 1)), 0.0)

    def correlations(self) -> np.ndarray:
        """Pearson correlations, NaN where a column has one value only."""
        scale = np.where(self.low < self.high, np.sqrt(np.clip(np.diag(self.spread), 0, None)), np.nan)
        scale[scale == 0] = np.nan
        return np.clip(self.spread / np.outer(scale, scale), -1, 1)

    def categories(self) -> dict[str, list[str]]:
        """Values of each category column, sorted."""
        found: dict[str, list[str]] = {}
        for name in sorted(n for n in self.names if _VALUE in n):
            column, _, value = name.partition(_VALUE)
            found.setdefault(column, []).append(value)
        return found

    def present_mean(self, column: str) -> float:
        """Mean of a column over the rows that have it; 0 if none has."""
        share = 1 - (self.mean[self.names.index(column + _MISSING)] if column + _MISSING in self.names else 0)
        return float(self.mean[self.names.index(column)] / share) if self.count and round(share * self.count) else 0.0

    def mapped(self, fills: dict[str, float], coded: dict[str, tuple[str, dict[str, float]]], names: list[str]) -> Moments:
        """Moments of ``names``: columns with missing values filled, or (category column, number of each value) in ``coded``."""
        place = {n: i for i, n in enumerate(self.names)}
        weights = np.zeros((len(names), len(self.names)))
        low, high = np.zeros(len(names)), np.zeros(len(names))
        for i, name in enumerate(names):
            if name in coded:
                column, numbers = coded[name]
                at = {v: place[column + _VALUE + v] for v in numbers if column + _VALUE + v in place}
                for value, j in at.items():
                    weights[i, j] = numbers[value]
                held = [numbers[v] for v, j in at.items() if self.mean[j] > 0] or [0.0]
                low[i], high[i] = min(held), max(held)
                continue
            j, missing = place[name], place.get(name + _MISSING)
            weights[i, j] = 1
            low[i], high[i] = self.low[j], self.high[j]
            if missing is not None and self.mean[missing] > 0:
                weights[i, missing] = fills[name]
                low[i], high[i] = min(low[i], fills[name]), max(high[i], fills[name])
        return Moments(names, self.count, weights @ self.mean, weights @ self.spread @ weights.T, low, high)


def of_rows(names: list[str], values: np.ndarray, indicators: dict[str, np.ndarray]) -> Moments:
    """Moments of some rows; NaN is a missing value."""
    missing = np.isnan(values)
    low, high = np.where(missing, np.inf, values).min(axis=0), np.where(missing, -np.inf, values).max(axis=0)
    flags = {names[i] + _MISSING: missing[:, i] for i in np.flatnonzero(missing.any(axis=0))} | indicators
    flat = np.column_stack([np.where(missing, 0.0, values), *[f.astype(float) for f in flags.values()]])
    mean = flat.mean(axis=0)
    away = flat - mean
    ends = flat[:, len(names) :]
    return Moments([*names, *flags], len(flat), mean, away.T @ away, np.append(low, ends.min(axis=0)), np.append(high, ends.max(axis=0)))


def _as_row(label: str | None, m: Moments) -> dict:
    return {
        "label": label, "n": m.count, "names": m.names, "mean": m.mean.tolist(), "spread": m.spread.ravel().tolist(),
        "low": m.low.tolist(), "high": m.high.tolist(),
    }


def _of_row(row) -> Moments:
    names = list(row["names"])
    mean, spread, low, high = (np.array(row[c], float) for c in ("mean", "spread", "low", "high"))
    return Moments(names, int(row["n"]), mean, spread.reshape(len(names), len(names)), low, high)


def _all_of(parts: Iterable[Moments], columns: list[str]) -> Moments:
    size = len(columns)
    nothing = Moments(list(columns), 0, np.zeros(size), np.zeros((size, size)), np.full(size, np.inf), np.full(size, -np.inf))
    return reduce(Moments.merged, parts, nothing)


def moments_by(df: DataFrame, columns: list[str], label: str | None = None, categories: Iterable[str] = (), none: str = "None") -> dict[str | None, Moments]:
    """Moments of numeric ``columns`` and of the indicators of ``categories`` for each class of ``label``, as text; one job.

    Null and NaN are missing in a number, and the category ``none`` in a category; a null label is a class of its own. All rows
    are one class without a label. An empty table has no class. Classes and categories are to be few: a task
    holds a square matrix of columns and category values for each class.
    """
    columns, categories = list(columns), list(categories)
    schema = pa.schema([("label", pa.string()), ("n", pa.int64()), ("names", pa.list_(pa.string())), *[(c, pa.list_(pa.float64())) for c in ("mean", "spread", "low", "high")]])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str | None, Moments] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.column_stack([batch.column(i + 1).to_numpy(zero_copy_only=False).astype(float) for i in range(len(columns))] or [np.zeros((batch.num_rows, 0))])
            flags = {}
            for i, c in enumerate(categories):
                texts = batch.column(1 + len(columns) + i).dictionary_encode()
                codes = texts.indices.to_numpy()
                flags |= {c + _VALUE + v: codes == k for k, v in enumerate(texts.dictionary.to_pylist())}
            classes = batch.column(0).dictionary_encode(null_encoding="encode")
            of_class = classes.indices.to_numpy()
            for k, name in enumerate(classes.dictionary.to_pylist()):
                rows = of_class == k
                here = of_rows(columns, values[rows], {c: f[rows] for c, f in flags.items()})
                found[name] = found[name].merged(here) if name in found else here
        yield pa.RecordBatch.from_pylist([_as_row(name, m) for name, m in found.items()], schema=schema)

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        whole = reduce(Moments.merged, (_of_row(r) for _, r in rows.iterrows()))
        name = rows["label"].iloc[0]
        return pd.DataFrame([_as_row(None if pd.isna(name) else name, whole)])

    numbers = [F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)]
    texts = [F.coalesce(F.col(c).cast("string"), F.lit(none)).alias(f"t{i}") for i, c in enumerate(categories)]
    group = (F.col(label).cast("string") if label else F.lit(None).cast("string")).alias("label")
    parts = df.select(group, *numbers, *texts).mapInArrow(partial, PARTIAL)
    merged = parts.groupBy("label", F.pmod(F.spark_partition_id(), F.lit(SLOTS)).alias("slot")).applyInPandas(merge, PARTIAL)
    by_class: dict[str | None, list[Moments]] = {}
    for row in merged.collect():
        by_class.setdefault(row["label"], []).append(_of_row(row))
    return {name: _all_of(found, columns) for name, found in by_class.items()}


def whole(classes: dict[str | None, Moments], columns: list[str]) -> Moments:
    """Moments of all classes together, in a fixed order of the classes."""
    return _all_of([classes[c] for c in sorted(classes, key=str)], columns)
