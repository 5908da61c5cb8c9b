"""Removal of repeated 400-byte passages by prefix-free parsing.

Parse. A rolling hash of every 16 bytes sets triggers that cut a text into phrases: of the first
``HEAD`` places of each 400-byte window the least hash (leftmost of equals) is the window's trigger.
Triggers depend on content alone, so equal windows have theirs at the same place, every window
has exactly one, and one trigger serves a run of windows: its context.

Prune. A trigger's key is the hash of the ``KEY`` bytes behind it, which each of its windows holds.
Keys that occur once leave no repeated window. Contexts equal in key and content (128 bits of
hash) are one entry of the dictionary. A key with one entry is settled: its windows are all repeated.

Order. For the other keys the dictionary's bytes are fetched. Entries of a key are put in the order of
what follows the trigger (suffix array and common prefixes of the parse); what stands before it is
named letter by letter from the trigger (suffixes of the dictionary). A window is a suffix of the
dictionary continued by the parse, so the pair (name of the suffix, class of equal
continuations) is its place in corpus order, and windows of one place are equal. A key with over
``CROWD`` entries would be too much for one task and leaves this path: its windows become rows, at most
``HEAD`` an entry, which Spark counts by 128-bit hash.

Cover. Repeated windows of an entry are carried to all its occurrences; per document their union goes.
No step makes pairs of occurrences; but for crowded keys, all tables grow with the number of triggers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import numbered, stored, whole_text, with_row_key

LENGTH = 400
HEAD = 300
KEY = 100
GRAM = 16
CROWD = 4096
# Window starts parsed at once, entries ordered at once.
SLICE = 1 << 20
ENTRIES = 1 << 14
# Odd multipliers of the rolling hash, from the fractional part of the golden ratio.
MIX = [np.uint64((0x9E3779B97F4A7C15 * k) % 2**64 | 1) for k in (1, 3, 7)]


def gram_hashes(data: bytes) -> np.ndarray:
    """Hash of the GRAM bytes at each place, the upper 32 bits; the lower 32 hold the place."""
    n = len(data) - 7
    eight = np.empty(n, np.uint64)
    for k in range(8):
        count = (len(data) - k) // 8
        eight[k::8][:count] = np.frombuffer(data, "<u8", count, k)
    h = eight[:-8] * MIX[0] + (eight[8:] ^ np.uint64(0x5555555555555555)) * MIX[1]
    h ^= h >> np.uint64(29)
    h *= MIX[2]
    return (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)


def sliding_least(values: np.ndarray, size: int) -> np.ndarray:
    span = 1
    while 2 * span <= size:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - (size - span)], values[size - span :]) if size > span else values


def triggers(data: bytes) -> Iterator[tuple[int, int, int]]:
    """(trigger, first window, last window) of a text, in order; none if it is shorter than a window."""
    windows = len(data) - LENGTH + 1
    for at in range(0, windows, SLICE):
        count = min(SLICE, windows - at)
        piece = data[at : at + count + HEAD - 1 + GRAM - 1]
        place = (sliding_least(gram_hashes(piece), HEAD)[:count] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        last = np.r_[first[1:] - 1, count - 1]
        yield from zip((place[first] + at).tolist(), (first + at).tolist(), (last + at).tolist())


def parsed(docs: DataFrame) -> DataFrame:
    """Triggers of all texts: rid, place, first, last, key, context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest as digest

        for batch in batches:
            rows = []
            for rid, text in zip(batch.column("rid").to_pylist(), batch.column("text")):
                data = text.as_buffer().to_pybytes()
                for p, s, e in triggers(data):
                    rows.append((rid, p, s, e, digest(data[p : p + KEY]), digest(data[s : e + LENGTH], p - s)))
                if len(rows) > SLICE:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)

    def batch_of(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows))
        hashes = [pa.array(np.array(c, np.uint64).view(np.int64)) for c in columns[4:]]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), *(pa.array(c, pa.int32()) for c in columns[1:4]), *hashes],
            names=["rid", "place", "first", "last", "key", "context"],
        )

    base = with_row_key(docs, whole_text().alias("text"))
    return base.mapInArrow(run, "rid long, place int, first int, last int, key long, context long")


def fetched(docs: DataFrame, entries: DataFrame) -> DataFrame:
    """Bytes of dictionary entries before and behind their trigger: key, context, n, before, behind. One row per text is read."""
    per_text = entries.groupBy("rid").agg(F.collect_list(F.struct("key", "context", "n", "place", "first", "last")).alias("entries"))
    texts = with_row_key(docs, whole_text().cast("binary").alias("data")).join(per_text, "rid")
    return texts.select(F.explode(
        F.transform(
            "entries",
            lambda e: F.struct(
                e["key"].alias("key"), e["context"].alias("context"), e["n"].alias("n"),
                F.substring("data", e["first"] + 1, e["place"] - e["first"]).alias("before"),
                F.substring("data", e["place"] + 1, e["last"] + LENGTH - e["place"]).alias("behind"),
            ),
        )
    ).alias("e")).select("e.*")


def order_entries(keys: np.ndarray, before: list[bytes], behind: list[bytes], copies: np.ndarray) -> list[list[tuple[int, int]]]:
    """Spans around the trigger, per entry, that repeated windows cover. Entries of a key stand together."""
    m = len(keys)
    order = sorted(range(m), key=lambda i: (keys[i], behind[i]))
    follows = np.zeros((m, LENGTH), np.uint8)
    sizes = np.zeros(m, np.int64)
    for row, i in enumerate(order):
        sizes[row] = len(behind[i])
        follows[row, : sizes[row]] = np.frombuffer(behind[i], np.uint8)
    differ = follows[1:] != follows[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), LENGTH)
    common = np.minimum(common, np.minimum(sizes[1:], sizes[:-1]))
    ranked = keys[order]
    common[ranked[1:] != ranked[:-1]] = -1
    lead = np.array([len(before[i]) for i in order])
    deepest = int(lead.max(initial=0))
    letters = np.zeros((m, deepest + 1), np.uint8)
    for row, i in enumerate(order):
        letters[row, 1 : lead[row] + 1] = np.frombuffer(before[i], np.uint8)[::-1]
    many = copies[order] > 1
    repeated = np.zeros((m, deepest + 1), bool)
    names = np.zeros(m, np.int64)
    for depth in range(deepest + 1):
        if depth:
            names = np.unique(names * 256 + letters[:, depth], return_inverse=True)[1]
        active = (lead >= depth) & (sizes >= LENGTH - depth)
        if not active.any():
            continue
        same = np.concatenate([[0], np.cumsum(common < LENGTH - depth)])
        place = names[active] * m + same[active]
        _, inverse, count = np.unique(place, return_inverse=True, return_counts=True)
        repeated[active, depth] = count[inverse] > 1
    repeated |= many[:, None] & (np.arange(deepest + 1) <= lead[:, None]) & (sizes[:, None] >= LENGTH - np.arange(deepest + 1))
    spans: list[list[tuple[int, int]]] = [[] for _ in range(m)]
    for row in np.flatnonzero(repeated.any(axis=1)):
        depths = np.flatnonzero(repeated[row])
        for run in np.split(depths, np.flatnonzero(np.diff(depths) > 1) + 1):
            spans[order[row]].append((-int(run[-1]), LENGTH - int(run[0])))
    return spans


SPANS = "key long, context long, spans array<struct<start:int,end:int>>"


def ordered(entries: DataFrame) -> DataFrame:
    """key, context and the repeated spans of entries, key by key in bounded chunks."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        waiting: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if len(waiting) >= ENTRIES and row[0] != waiting[-1][0]:
                    yield waiting
                    waiting = []
                waiting.append(row)
        if waiting:
            yield waiting

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in chunks(batches):
            keys, contexts, copies, before, behind = zip(*rows)
            spans = order_entries(np.array(keys, np.int64), before, behind, np.array(copies))
            found = [i for i, s in enumerate(spans) if s]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([keys[i] for i in found], pa.int64()), pa.array([contexts[i] for i in found], pa.int64()),
                    pa.array([[{"start": a, "end": b} for a, b in spans[i]] for i in found], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                ],
                names=["key", "context", "spans"],
            )

    placed = entries.select("key", "context", "n", "before", "behind").repartition("key").sortWithinPartitions("key")
    return placed.mapInArrow(run, SPANS)


def counted(entries: DataFrame) -> DataFrame:
    """The same for keys with too many entries for one task: windows are rows, counted by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest as digest

        for batch in batches:
            for key, context, n, before, behind in zip(*(c.to_pylist() for c in batch.columns)):
                data, lead = bytes(before) + bytes(behind), len(before)
                rows = [(lead - s, digest(data[s : s + LENGTH])) for s in range(len(data) - LENGTH + 1)]
                depths, hashes = zip(*rows)
                k = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * k, pa.int64()), pa.array([context] * k, pa.int64()), pa.array([n] * k, pa.int64()), pa.array(depths, pa.int32()), pa.array(hashes, pa.binary())],
                    names=["key", "context", "n", "depth", "window"],
                )

    windows = entries.select("key", "context", "n", "before", "behind").mapInArrow(run, "key long, context long, n long, depth int, window binary")
    windows = stored(windows, "windows")
    again = windows.groupBy("window").agg(F.sum("n").alias("total")).filter("total > 1")
    spans = F.collect_list(F.struct((-F.col("depth")).cast("int").alias("start"), (LENGTH - F.col("depth")).cast("int").alias("end")))
    return windows.join(again, "window").groupBy("key", "context").agg(spans.alias("spans"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """rid and the spans [start, end) of its text that repeated windows cover; spans may overlap."""
    marks = stored(parsed(docs), "triggers")
    # Counts are written before they are joined: then AQE can split a key that very many texts share.
    twice = cut_lineage(marks.groupBy("key").count().filter("count > 1").select("key"))
    marks = stored(marks.join(twice, "key"), "repeated")
    first = [F.first(c).alias(c) for c in ("rid", "place", "first", "last")]
    entries = stored(marks.groupBy("key", "context").agg(F.count(F.lit(1)).alias("n"), *first), "entries")
    kinds = entries.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    kinds = cut_lineage(kinds)
    contents = stored(fetched(docs, entries.join(kinds, "key")).join(kinds, "key"), "contents")
    solved = ordered(contents.filter(F.col("kinds") <= CROWD)).union(counted(contents.filter(F.col("kinds") > CROWD)))
    solved = stored(solved, "solved")
    known = marks.join(kinds, "key", "left")
    settled = known.filter("kinds IS NULL").select("rid", F.col("first").alias("start"), (F.col("last") + LENGTH).alias("end"))
    others = (
        known.filter("kinds IS NOT NULL").join(solved, ["key", "context"])
        .select("rid", "place", F.explode("spans").alias("s"))
        .select("rid", (F.col("place") + F.col("s.start")).alias("start"), (F.col("place") + F.col("s.end")).alias("end"))
    )
    return settled.union(others)


def cut(data: bytes, spans: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], bytes]:
    """Maximal runs of the spans' union, and the bytes outside."""
    runs: list[list[int]] = []
    for start, end in sorted(spans):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    edges = [0, *(x for r in runs for x in r), len(data)]
    return [tuple(r) for r in runs], b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))


def drop_repeats(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: rid, doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed, kept.

    Every byte in a 400-byte string that also starts at another place of any text, the same one
    included, is removed; strings are judged on the input. A null text is empty; a text under 400
    bytes stays whole; rows that repeat lose what they share, all of them. An empty table gives no
    rows; other columns are not read. ``removed`` holds the maximal removed runs
    of bytes, in order, ``kept`` the remaining bytes, null without ``keep_text``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for data, spans in zip(batch.column("data"), batch.column("spans").to_pylist()):
                data = data.as_buffer().to_pybytes()
                runs, rest = cut(data, [(s["start"], s["end"]) for s in spans or []])
                cuts = [{"start": a, "end": b} for a, b in runs]
                rows.append((len(data), len(data) - len(rest), len(runs), hashlib.sha256(rest).hexdigest(), cuts, rest if keep_text else None))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), span, pa.binary())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("doc_id"), *columns],
                names=["rid", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed", "kept"],
            )

    docs = numbered(docs.select("doc_id", "text"))
    per_text = repeated_spans(docs).groupBy("rid").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    texts = with_row_key(docs, F.col("doc_id").cast("long").alias("doc_id"), whole_text().cast("binary").alias("data")).join(per_text, "rid", "left")
    return texts.mapInArrow(run, "rid long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start:long,end:long>>, kept binary")


def op7_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """What is removed of every document, and the digest of the rest."""
    return drop_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep_text=False).drop("rid", "kept")
