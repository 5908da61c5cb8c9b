"""Language identification by cross-parsing entropy.

Of each language a bounded sample of labelled text becomes a suffix automaton, built by one task
per language. A text is parsed against it: each phrase is the longest match in the sample
from where the last one ended, found by walking the automaton until no transition is left. A phrase
costs the logarithm of the sample's length, since it is named by a place there. Phrases times that
logarithm, per character, estimate the cross entropy, and the language with the least wins.

Texts count as lower-case letters, with one space for each run of anything else. The automaton is a
table of transitions in which a missing one leads where a new phrase would start, and says so: a
step of many texts and all languages is one look-up of an array. Long texts are parsed in pieces of
``PIECE`` characters, whose phrases are summed: nothing is left out, and memory is bounded.

Scoring is one pass over the documents and shuffles nothing. Sample bounds: ``SAMPLE_DOCS`` labelled
documents and ``SAMPLE_CHARS`` characters a language, taken in the order of a hash; with many
languages fewer characters, ``SAMPLE_TOTAL`` over their number, so that the table stays bounded.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_DOCS = 1000
SAMPLE_CHARS = 1 << 16
SAMPLE_TOTAL = 1 << 18
SAMPLE_PIECE = 512
# Letters with a code of their own, the most frequent of the samples; others share one.
LETTERS = 124
SPACE, OTHER, FIRST = 0, 1, 2
PIECE = 2048
# Pieces parsed side by side.
WIDTH = 1024
# Rows whose crc32 of the id has this remainder are held out.
FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"


def held_out(name: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the empty match."""
    go: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        here = len(go)
        go.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = here
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[p] + 1 == length[q]:
                link[here] = q
            else:
                clone = len(go)
                go.append(dict(go[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = clone
                    p = link[p]
                link[q] = link[here] = clone
        last = here
    return go


@dataclass(frozen=True)
class Model:
    """Per language, in order: the length of the sample and its automaton's transitions (state, code, next), numbered breadth first."""

    languages: tuple[str, ...] = ()
    letters: str = ""
    sizes: tuple[int, ...] = ()
    states: tuple[int, ...] = ()
    moves: tuple[bytes, ...] = field(default=(), repr=False)


@lru_cache(maxsize=1)
def letter_table(letters: str) -> np.ndarray:
    """Code of every code point: a letter's own, OTHER for further letters, SPACE for the rest."""
    table = np.fromiter((OTHER if chr(i).isalpha() else SPACE for i in range(0x110000)), np.uint8, 0x110000)
    table[list(map(ord, letters))] = np.arange(FIRST, FIRST + len(letters))
    return table


def codes_of(text: str, table: np.ndarray) -> np.ndarray:
    """Codes of a whole text in lower case, one SPACE for each run of no letters."""
    codes = table[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")]
    return codes[np.r_[True, (codes[1:] != SPACE) | (codes[:-1] != SPACE)]] if len(codes) else codes


def moves_of(codes: list[int]) -> tuple[int, bytes]:
    """Number of states, and the transitions as three rows of integers. States near the start, which most steps visit, come first."""
    go = automaton(codes)
    number, order = {0: 0}, [0]
    for state in order:
        for c in sorted(go[state]):
            if go[state][c] not in number:
                number[go[state][c]] = len(order)
                order.append(go[state][c])
    rows = [(number[s], c, number[t]) for s in order for c, t in go[s].items()]
    return len(order), np.array(rows, "<i4").reshape(-1, 3).T.tobytes()


def sample(docs: DataFrame) -> list[tuple[str, str]]:
    """(language, text) in order: pieces of labelled documents outside the held-out third, in the order of a hash up to the bounds."""
    known = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    known = known.filter(F.col("lang").isNotNull() & ~held_out())
    # One row for each language; the model has a table for each, so they are few.
    counts = F.broadcast(known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))
    # A hash of the text lets through about twice the documents that are wanted; copies are one text.
    draw = F.xxhash64("text", F.lit("sample"))
    share = draw.bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))
    some = known.join(counts, "lang").filter(share * F.col("n") < 2 * SAMPLE_DOCS).select("lang", "text", draw.alias("draw"))
    some = some.dropDuplicates(["lang", "draw"])
    # Some 2 * SAMPLE_DOCS texts of each language are left.
    first = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    few = some.withColumn("place", first).filter(F.col("place") <= SAMPLE_DOCS)
    starts = F.sequence(F.lit(0), F.floor((F.char_length("text") - 1) / SAMPLE_PIECE))
    pieces = few.filter("text <> ''").select("lang", F.explode(F.transform(starts, lambda i: F.substring(F.col("text"), (i * SAMPLE_PIECE + 1).cast("int"), F.lit(SAMPLE_PIECE)))).alias("piece"))
    mixed = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("piece"), "piece"))
    taken = pieces.withColumn("place", mixed).filter(F.col("place") <= SAMPLE_CHARS // SAMPLE_PIECE)
    found: dict[str, list[str]] = {}
    for row in taken.orderBy("lang", "place").collect():
        found.setdefault(row["lang"], []).append(row["piece"])
    most = max(SAMPLE_PIECE, min(SAMPLE_CHARS, SAMPLE_TOTAL // max(1, len(found)))) // SAMPLE_PIECE
    return [(lang, " ".join(found[lang][:most])) for lang in sorted(found)]


def fit(docs: DataFrame) -> Model:
    """Automata of the labelled languages, each built by a task of its own."""
    texts = sample(docs)
    letters = Counter(c for _, text in texts for c in text.lower() if c.isalpha())
    letters = "".join(sorted(sorted(letters, key=lambda c: (-letters[c], c))[:LETTERS]))
    table = letter_table(letters)
    coded = [(lang, codes_of(text, table).tobytes()) for lang, text in texts]
    coded = [(lang, codes) for lang, codes in coded if np.frombuffer(codes, np.uint8).any()]
    if not coded:
        return Model()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, codes in zip(batch.column("lang").to_pylist(), batch.column("codes").to_pylist()):
                states, moves = moves_of(list(codes))
                columns = [pa.array([lang]), pa.array([len(codes)], pa.int64()), pa.array([states], pa.int64()), pa.array([moves], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "size", "states", "moves"])

    spark = docs.sparkSession
    rows = spark.createDataFrame([(lang, bytearray(codes)) for lang, codes in coded], "lang string, codes binary").repartition(len(coded))
    built = sorted(map(tuple, rows.mapInArrow(build, "lang string, size long, states long, moves binary").collect()))
    languages, sizes, states, moves = zip(*built)
    return Model(languages, letters, sizes, states, tuple(map(bytes, moves)))


@lru_cache(maxsize=1)
def steps(model: Model) -> tuple[np.ndarray, np.ndarray, int]:
    """One table for all automata, the state in which each begins, and the number of codes.

    A state is the place of its row, an entry twice the next state, odd if a new phrase begins. The state
    at which no phrase has begun comes behind the others of its automaton.
    """
    width = FIRST + len(model.letters)
    parts, begins, offset = [], [], 0
    for states, moves in zip(model.states, model.moves):
        state, code, after = np.frombuffer(moves, "<i4").reshape(3, -1)
        go = np.full((states + 1, width), -1, np.int64)
        go[state, code] = after
        fresh = np.where(go[0] < 0, states, go[0])
        parts.append(((np.where(go < 0, fresh, go) + offset) * width * 2 + (go < 0)).astype(np.int32).ravel())
        begins.append((offset + states) * width)
        offset += states + 1
    return np.concatenate(parts), np.array(begins, np.int64), width


def phrases(pieces: list[np.ndarray], model: Model) -> np.ndarray:
    """Phrases of every piece in every language, step by step for all pieces that are long enough."""
    table, begins, _ = steps(model)
    sizes = np.array([len(p) for p in pieces])
    order = np.argsort(-sizes, kind="stable")
    grid = np.zeros((int(sizes.max(initial=0)), len(pieces), 1), np.int64)
    for column, i in enumerate(order):
        grid[: sizes[i], column, 0] = pieces[i]
    active = np.searchsorted(-sizes[order], -np.arange(len(grid)), "left")
    state = np.tile(begins, (len(pieces), 1))
    count = np.zeros(state.shape, np.int64)
    for t, n in enumerate(active.tolist()):
        entry = table[state[:n] + grid[t, :n]]
        count[:n] += entry & 1
        state[:n] = entry >> 1
    out = np.empty_like(count)
    out[order] = count
    return out


def verdicts(texts: list[str | None], model: Model, table: np.ndarray) -> Iterator[tuple[str, float]]:
    """Language and score of each text."""
    codes = [codes_of(t or "", table) for t in texts]
    pieces = [(k, c[at : at + PIECE]) for k, c in enumerate(codes) for at in range(0, len(c), PIECE)]
    total = np.zeros((len(texts), len(model.languages)))
    for at in range(0, len(pieces) if model.languages else 0, WIDTH):
        part = pieces[at : at + WIDTH]
        np.add.at(total, [k for k, _ in part], phrases([c for _, c in part], model))
    for c, sums in zip(codes, total * np.log2(np.array(model.sizes) + 1.0)):
        if not c.any() or not len(sums):
            yield UNKNOWN, 0.0
            continue
        best = int(sums.argmin())
        rest = np.delete(sums, best)
        yield model.languages[best], float(rest.min() / (rest.min() + sums[best])) if len(rest) else 1.0


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    Only the text decides. ``lang_pred`` is the language of least cross entropy, the first in code
    point order of equal ones; ``score`` is the runner-up's part of the entropy of both, a half for
    equal ones, 1 if no other language was learned. A null text, one without a letter, or a model
    without languages gives ``und`` and 0. Repeated rows repeat, null doc_ids stay and count as the
    empty text in the hash; an empty table gives no rows; other columns are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = letter_table(held.value.letters)
        for batch in batches:
            for at in range(0, batch.num_rows, WIDTH):
                part = batch.slice(at, WIDTH)
                found = list(verdicts(part.column("text").to_pylist(), held.value, table))
                columns = [pa.array([v[0] for v in found], pa.string()), pa.array([v[1] for v in found], pa.float64())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), *columns], names=["doc_id", "held_out", "lang_pred", "score"])

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return base.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def op13_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of every document by a model of two thirds of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(docs, fit(docs))
