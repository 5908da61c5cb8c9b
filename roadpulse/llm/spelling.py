"""Grouping of spelling variants by pivotal grams.

Bigrams of all words are ranked, rare first. The prefix of a word holds its occurrences of bigrams
up to the rank of the third; of these, dynamic programming over the places picks the two disjoint
ones with the least total frequency, its pivots. One edit leaves one of two disjoint pivots whole.
Of two words one edit apart, take the one whose prefix ends at the lower rank: its pivot that is
left whole also stands in the other's prefix, which holds all occurrences up to a rank not below.

Position limits: the edit lies on one side of that pivot, so on the other side, before it or
behind it, both words have as many code points, and the same. A pivot is therefore looked up by bigram, what stands on
a side of it (by hash), and the other word's length, which is the same, one less or one more: six keys
against two of each prefix place. What is found is compared by the parities of its letters, of which one edit changes at most
two, and verified by edit distance. Links are never made within
a bigram's whole list, no bucket is capped, and a crowded key is a join key that AQE can split.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import stored

# Letters of a run, upper case that is lowered, and the rule of the deleted letter.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}
DELETED = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
# A form has at least so many times the occurrences.
RATIO = 2
# Distinct words that a task counts before it sends them on.
HELD = 1 << 18


def words_of(doc_id: int | None, text: str) -> Iterator[tuple[str, int]]:
    """Words of a text with their numbers: runs lower-cased, less a letter where 97 divides the hash of id and run."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(RUN.findall(text)).items():
        word = run.lower() if run.isascii() else run.translate(LOWER)
        h = zlib.crc32(word.encode(), start)
        if h % DELETED == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        yield word, n


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n of all words of at least ``least_length`` code points and ``least_count`` occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> Iterator[pa.RecordBatch]:
            words, numbers = list(counts), list(counts.values())
            for at in range(0, len(words), 1 << 14):
                part = pa.array(words[at : at + (1 << 14)], pa.string()), pa.array(numbers[at : at + (1 << 14)], pa.int64())
                yield pa.RecordBatch.from_arrays(list(part), names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                for word, n in words_of(doc_id, text.as_py()):
                    if len(word) >= least_length:
                        counts[word] += n
                if len(counts) > HELD:
                    yield from out()
                    counts.clear()
        yield from out()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def pivots(grams: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The two disjoint bigrams (at, count) of a prefix with the least total count, by dynamic programming over rising places.

    ``best`` is the cheapest bigram that ends before the place in hand.
    """
    grams = sorted(grams)
    best, found, behind = None, None, 0
    for gram in grams:
        while grams[behind][0] <= gram[0] - 2:
            if best is None or grams[behind][1] < best[1]:
                best = grams[behind]
            behind += 1
        if best is not None and (found is None or best[1] + gram[1] < found[0][1] + found[1][1]):
            found = best, gram
    return list(found or ())


def letters(word: str) -> int:
    """A bit for each letter (some share one), set if it stands in the word an odd number of times."""
    bits = 0
    for c in word:
        bits ^= 1 << ord(c) % 63
    return bits


def gram_rows(words: DataFrame, frequencies: DataFrame) -> DataFrame:
    """Per word its length, its letters, the rank (frequency, gram) that ends its prefix, and the prefix: gram, at, pivot or not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = pa.struct([("gram", pa.string()), ("at", pa.int32()), ("pivot", pa.bool_())])
        for batch in batches:
            ends, prefixes = [], []
            for grams in batch.column("grams").to_pylist():
                ranked = sorted(((g["f"], g["gram"], g["at"]) for g in grams))
                end = ranked[min(2, len(ranked) - 1)][:2]
                prefix = [g for g in ranked if g[:2] <= end]
                chosen = {at for at, _ in pivots([(at, f) for f, _, at in prefix])}
                ends.append({"f": end[0], "gram": end[1]})
                prefixes.append([{"gram": g, "at": at, "pivot": at in chosen} for _, g, at in prefix])
            odd = pa.array([letters(w) for w in batch.column("word").to_pylist()], pa.int64())
            columns = [batch.column("word"), batch.column("length"), odd, pa.array(ends, pa.struct([("f", pa.int64()), ("gram", pa.string())])), pa.array(prefixes, pa.list_(place))]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "length", "letters", "last", "prefix"])

    spread = words.select("word", F.char_length("word").alias("length"), F.posexplode(bigrams()).alias("at", "gram"))
    # Bigrams are at most the square of the letters, a few thousand; without the hint Spark may send the words instead.
    counted = spread.join(F.broadcast(frequencies), "gram").groupBy("word", "length").agg(F.collect_list(F.struct("gram", "at", "f")).alias("grams"))
    return counted.mapInArrow(run, "word string, length int, letters long, last struct<f:long,gram:string>, prefix array<struct<gram:string,at:int,pivot:boolean>>")


def bigrams():
    """All bigrams of ``word``, in order."""
    return F.transform(F.sequence(F.lit(1), F.char_length("word") - 1), lambda i: F.substring(F.col("word"), i, F.lit(2)))


def near_pairs(words: DataFrame) -> DataFrame:
    """Pairs (a, b) of distinct ``word`` one inserted, deleted or replaced code point apart, both ways round.

    Words have at least five code points: then the prefix of each holds two disjoint bigrams.
    """
    spread = words.select(F.explode(bigrams()).alias("gram"))
    frequencies = cut_lineage(spread.groupBy("gram").agg(F.count(F.lit(1)).alias("f")))
    placed = stored(gram_rows(words, frequencies), "grams").select("word", "length", "letters", "last", F.explode("prefix").alias("g"))
    word, at, length = F.col("word"), F.col("g.at"), F.col("length")
    # What stands before the bigram, or behind it, and how long the other word is.
    before = F.xxhash64(F.lit("before"), F.substring(word, F.lit(1), at))
    behind = F.xxhash64(F.lit("behind"), F.substring(word, at + 3, length))

    def key(side, n):
        return F.struct(side.alias("side"), n.cast("int").alias("length"))

    wanted = F.array(key(before, length), key(behind, length), *(key(side, length + d) for side in (before, behind) for d in (1, -1)))
    kept = F.array(key(before, length), key(behind, length))
    left = placed.filter("g.pivot").select(word.alias("a"), F.col("letters").alias("letters_a"), F.col("last").alias("last_a"), F.col("g.gram").alias("gram"), F.inline(wanted))
    right = placed.select(word.alias("b"), F.col("letters").alias("letters_b"), F.col("last").alias("last_b"), F.col("g.gram").alias("gram"), F.inline(kept))
    # Spark sizes both by the file of words, not by the rows that come of each, and would broadcast them.
    met = left.hint("merge").join(right, ["gram", "side", "length"])
    alike = F.bit_count(F.col("letters_a").bitwiseXOR(F.col("letters_b"))) <= 2
    found = met.filter(alike & (F.col("a") != F.col("b")) & (F.col("last_a") <= F.col("last_b"))).filter(F.levenshtein("a", "b", 1) == 1)
    both = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    return found.select(F.inline(both)).distinct()


def rooted(forms: DataFrame) -> DataFrame:
    """word, root from (word, form): what following forms leads to. Numbers at least double along the way, so there are no rings.

    Each round looks up the root so far as a word of its own, which doubles the length of the way.
    """
    current = cut_lineage(forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = cut_lineage(current.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        current = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return current


def variants(docs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """One row per word of ``docs``: word, form, root, n, n_near, form_n.

    A null or empty text has no words, a null doc_id is the empty text in the hash; repeated rows
    count again; of near words with equal numbers the smallest in code-point order is the form; an
    empty table gives no rows; other columns are not read.
    """
    words = stored(vocabulary(docs), "words")
    numbers = words.select(F.col("word").alias("b"), F.col("n").alias("m"))
    # The order of UTF-8 bytes is that of code points.
    best = F.min(F.struct((-F.col("m")).alias("less"), F.col("b").alias("word"))).alias("best")
    # Sized by its compressed file as well.
    near = cut_lineage(near_pairs(words).join(numbers.hint("merge"), "b").groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), best))
    found = words.join(near, "word", "left").withColumn("form_n", -F.col("best.less"))
    enough = F.col("form_n") >= ratio * F.col("n")
    forms = cut_lineage(found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("best.word")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n")))
    return forms.join(rooted(forms), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.col("n_near").cast("long").alias("n_near"), "form_n")


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """Every word of the documents with its form and root."""
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))
