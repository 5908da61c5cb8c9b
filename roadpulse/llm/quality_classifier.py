"""Compression classifier: two zstandard dictionaries and a calibrated size difference.

One dictionary is built from labelled good text, one from bad text. A text is compressed with
each, chunk by chunk, so that the dictionary and not the text's own past decides; whole texts are
read. The difference of the two compressed sizes over their sum, together with the size against
the text's length, becomes a score by a logistic curve fitted on labelled rows that the
dictionaries have not seen.

The model is fitted on a bounded sample: at most ``SAMPLE_DOCS`` documents of each label, at most
``SAMPLE_CHUNKS`` chunks of ``CHUNK`` bytes of each label reach the driver. Scoring is one pass
over the documents and shuffles nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import whole_text, with_row_key

CHUNK = 1024
SAMPLE_DOCS = 3000
SAMPLE_CHUNKS = 6000
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
THRESHOLD = 0.3
# Rows whose crc32 of the id is divisible by this are held out.
FOLDS = 5
# Penalty on the standardised weights of the curve.
RIDGE = 1.0


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]


def held_out(name: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def compressors(good: bytes, bad: bytes) -> list:
    import zstandard as z

    out = []
    for data in (good, bad):
        dictionary = z.ZstdCompressionDict(data) if data else None
        if dictionary:
            dictionary.precompute_compress(level=LEVEL)
        options = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
        out.append(z.ZstdCompressor(level=LEVEL, dict_data=dictionary, **options) if dictionary else z.ZstdCompressor(level=LEVEL, **options))
    return out


def sizes(data: bytes, tools: list) -> tuple[int, int, int]:
    """Length, and compressed size with the good and with the bad dictionary."""
    chunks = [data[i : i + CHUNK] for i in range(0, len(data), CHUNK)]
    return len(data), *(sum(len(t.compress(c)) for c in chunks) for t in tools)


def features(n: np.ndarray, good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Columns: one, normalised size difference, size per byte and its square; an empty text has zeros."""
    ratio = np.where(n > 0, np.minimum(good, bad) / np.maximum(n, 1), 0.0)
    return np.stack([np.ones(len(n)), 10 * (bad - good) / np.maximum(good + bad, 1), ratio, ratio**2], axis=1)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Ridge logistic regression on standardised columns by Newton steps; with one label only, its smoothed share."""
    share = (y.sum() + 1) / (len(y) + 2)
    w = np.zeros(x.shape[1])
    w[0] = np.log(share / (1 - share))
    if len(set(y.tolist())) < 2:
        return tuple(w.tolist())
    mean, spread = x[:, 1:].mean(axis=0), x[:, 1:].std(axis=0) + 1e-9
    x = np.c_[x[:, :1], (x[:, 1:] - mean) / spread]
    penalty = np.r_[1e-9, np.full(len(w) - 1, RIDGE)]
    for _ in range(50):
        p = logistic(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    raw = w[1:] / spread
    return tuple(float(v) for v in np.r_[w[0] - raw @ mean, raw])


def measured(base: DataFrame, good: bytes, bad: bytes) -> DataFrame:
    """The columns of ``base`` ahead of its last one, the text, with n, good, bad: length and compressed sizes of the whole text."""
    carried = base.schema.fields[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = compressors(good, bad)
        for batch in batches:
            columns = list(zip(*(sizes(t.as_buffer().to_pybytes(), tools) for t in batch.columns[-1]))) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(c, pa.int64()) for c in columns)], names=[*batch.schema.names[:-1], "n", "good", "bad"]
            )

    return base.mapInArrow(run, StructType([*carried, *(StructField(c, LongType()) for c in ("n", "good", "bad"))]))


def sample_ids(labels: DataFrame) -> DataFrame:
    """doc_id, quality, part of at most SAMPLE_DOCS labelled rows of each label outside the held-out fold, in hash order."""
    known = labels.select("doc_id", "quality").filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    order = F.xxhash64("doc_id", F.lit("sample"))
    of = lambda q: known.filter(F.col("quality") == q).orderBy(order, "doc_id").limit(SAMPLE_DOCS)
    return of(0).union(of(1)).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(5)))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Dictionaries from three fifths of the sampled rows, the curve from the other two."""
    ids = F.broadcast(sample_ids(labels))
    texts = docs.select("doc_id", whole_text().alias("text")).join(ids, "doc_id")
    data = F.col("text").cast("binary")
    pieces = F.transform(
        F.sequence(F.lit(0), F.ceil(F.octet_length("text") / CHUNK).cast("int")), lambda i: F.substring(data, i * CHUNK + 1, F.lit(CHUNK))
    )
    chunks = texts.filter("part < 3").select("quality", F.explode(pieces).alias("chunk")).filter(F.octet_length("chunk") > 0)
    order = F.xxhash64("chunk")
    parts = {q: [r[0] for r in chunks.filter(F.col("quality") == q).select("chunk").orderBy(order, "chunk").limit(SAMPLE_CHUNKS).collect()] for q in (0, 1)}
    few = min(sum(map(len, parts[q])) for q in (0, 1))
    good, bad = (dictionary(parts[q], few) for q in (1, 0))
    labelled = measured(texts.filter("part >= 3").select(F.col("doc_id").cast("long").alias("doc_id"), "text"), good, bad).join(ids, "doc_id")
    # Ids may repeat in the documents: as many rows as ids are taken, in an order of their own.
    labelled = labelled.orderBy(F.xxhash64("doc_id", "n", "good", "bad"), "n", "good", "bad").limit(2 * SAMPLE_DOCS).select("n", "good", "bad", "quality")
    rows = np.array([tuple(r) for r in labelled.collect()], float).reshape(-1, 4)
    return Model(good, bad, fit_curve(features(*rows[:, :3].T), rows[:, 3]))


def dictionary(chunks: list[bytes], most: int) -> bytes:
    """Zstandard dictionary content of chunks of up to ``most`` bytes in all; trained if there is enough text, else the text itself."""
    import zstandard as z

    taken, size = [], 0
    for chunk in chunks:
        if size >= most:
            break
        taken.append(bytes(chunk))
        size += len(chunk)
    content = b"".join(taken)[-DICTIONARY_BYTES:]
    if size < 8 * len(content):
        return content
    try:
        return z.train_dictionary(DICTIONARY_BYTES, taken, level=LEVEL).as_bytes()
    except z.ZstdError:  # too alike or too few to train on
        return content


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: rid, doc_id, held_out, score, predicted.

    Only the text decides the score. Null counts as empty, which has a score of its own. Repeated
    rows repeat; an empty table gives no rows; other columns, whatever their names, are not read.
    """
    base = with_row_key(docs, F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    value = score_of(model)
    return measured(base, model.good, model.bad).select(
        "rid", "doc_id", held_out().alias("held_out"), value.alias("score"), (value >= THRESHOLD).cast("int").alias("predicted")
    )


def score_of(model: Model) -> Column:
    """Score from the columns n, good and bad."""
    n, good, bad = (F.col(c).cast("double") for c in ("n", "good", "bad"))
    ratio = F.when(F.col("n") > 0, F.least(good, bad) / n).otherwise(0.0)
    diff = 10 * (bad - good) / F.greatest(good + bad, F.lit(1.0))
    w = [F.lit(float(x)) for x in model.weights]
    line = w[0] + w[1] * diff + w[2] * ratio + w[3] * ratio * ratio
    return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), line))))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the classifier rejects, all columns as they were, whatever their names.

    A null text is judged as an empty one; repeated rows stay or go together; an empty table stays empty.
    """
    model = fit(docs, labels)
    # Each row goes along whole: no key, no join.
    base = docs.select(F.struct("*").alias("row"), whole_text().alias("text"))
    return measured(base, model.good, model.bad).filter(score_of(model) >= THRESHOLD).select("row.*")


def op8_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Score of every document by a model of the labels outside the held-out fold."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return score(docs, fit(docs, labels)).drop("rid")
