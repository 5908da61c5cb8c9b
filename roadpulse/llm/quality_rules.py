"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps the measurements and one bit per failed
rule. A policy is a version name and a mask of the rules it enforces: applying it is one bitwise
AND, and what a rule alone costs (its ablation) follows from counts of equal bit patterns, without
reading a text again. Everything is computed on the document's row, so nothing is shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, let, whole_text

SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Rules by bit. They fail where the condition over the measurements holds.
RULES = {
    "few_words": "n_words < 20",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "word_length": "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)",
    "symbols": "10 * n_symbols > 3 * n_words",
    "duplicate_lines": "n_lines > 0 AND 100 * n_dup_lines > 50 * n_lines",
    "upper_case": "word_chars > 0 AND 100 * n_upper > 50 * word_chars",
}
BITS = {name: 1 << i for i, name in enumerate(RULES)}


def mask(*rules: str) -> int:
    return sum(BITS[r] for r in rules)


# Versioned policies: which rules decide.
POLICIES = {
    "base-1": mask("few_words", "repeated_words"),
    "full-1": mask("few_words", "repeated_words", "word_length", "symbols", "duplicate_lines"),
    "full-2": mask(*RULES),
}
CURRENT = "full-2"


def without(text: Column, characters) -> Column:
    return reduce(lambda t, c: F.replace(t, F.lit(c)), characters, text)


def window_hashes(words: Column) -> Column:
    """One hash per window of WINDOW words: of single words, then of pairs of neighbours, of fours, of eights."""
    hashes, span = F.transform(words, lambda w: F.xxhash64(w)), 1
    while span < WINDOW:
        step = span
        hashes = let(
            hashes,
            lambda h: F.zip_with(F.slice(h, 1, F.size(h) - step), F.slice(h, step + 1, F.size(h) - step), lambda a, b: F.xxhash64(a, b)),
        )
        span *= 2
    return hashes


def repeated_words(words: Column, hashes: Column) -> Column:
    """Words in windows of WINDOW words that occur at least twice, the first included.

    ``hashes`` are the windows' hashes in order. Sorted with their places, equal windows are
    neighbours, and their content is compared; the places found then cover the union of their windows.
    """
    same = lambda a, b: (a["h"] == b["h"]) & (
        F.slice(words, a["i"] + 1, WINDOW) == F.slice(words, b["i"] + 1, WINDOW)
    )
    twice = let(
        F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        lambda places: F.filter(
            places,
            lambda p, k: F.coalesce(F.when(k > 0, same(p, F.get(places, k - 1))), F.lit(False))
            | F.coalesce(same(p, F.get(places, k + 1)), F.lit(False)),
        ),
    )
    starts = F.sort_array(F.transform(twice, lambda p: p["i"]))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(
        starts, zero,
        lambda acc, s: F.struct((s + WINDOW).alias("end"), (acc["n"] + s + WINDOW - F.greatest(acc["end"], s)).alias("n")),
        lambda acc: acc["n"],
    )


def word_measures(words: Column) -> Column:
    """Measurements over the words of a text."""
    windows = F.when(F.size(words) >= WINDOW, window_hashes(words)).otherwise(F.array().cast("array<bigint>"))
    n_repeat = let(windows, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), repeated_words(words, h)).otherwise(0))
    packed = let(
        F.array_join(words, ""),
        lambda p: F.struct(
            F.char_length(p).cast("long").alias("word_chars"),
            (F.octet_length(p) - F.octet_length(without(p, SYMBOLS))).cast("long").alias("n_symbols"),
            F.char_length(F.regexp_replace(p, "[^A-Z]+", "")).cast("long").alias("n_upper"),
        ),
    )
    return F.struct(
        F.size(words).cast("long").alias("n_words"), n_repeat.cast("long").alias("n_repeat_words"), packed.alias("chars")
    )


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of every text; a null text has none of anything."""
    text, blank = F.col("text"), F.lit(" " + "".join(SPACES))
    words = let(
        F.btrim(text, blank),
        lambda t: F.when(F.octet_length(t) > 0, F.split(t, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>")),
    )
    # A line with a word is one that is not whitespace only.
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.octet_length(F.btrim(x, blank)) > 0)
    counted = let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")
        ),
    )
    return (
        docs.select("doc_id", whole_text().alias("text"))
        .select("doc_id", let(words, word_measures).alias("w"), counted.alias("l"))
        .select("doc_id", "w.n_words", "w.chars.word_chars", "w.chars.n_symbols", "l.n_lines", "l.n_dup_lines", "w.n_repeat_words", "w.chars.n_upper")
    )


def ledger(docs: DataFrame) -> DataFrame:
    """Measurements and ``fail_bits``, one bit per failed rule, of every row of ``docs``.

    An empty or null text fails few_words. Rows are judged on their own: repeated rows repeat, an
    empty table gives an empty ledger, and other columns are not read.
    """
    bits = reduce(lambda a, b: a.bitwiseOR(b), [F.when(F.expr(c), F.lit(BITS[n])).otherwise(F.lit(0)) for n, c in RULES.items()])
    return measured(docs).withColumn("fail_bits", bits)


def apply_policy(found: DataFrame, version: str = CURRENT) -> DataFrame:
    """Adds base_failed, kept and policy by a policy's mask."""
    return found.withColumns(
        {
            "base_failed": F.col("fail_bits").bitwiseAND(F.lit(POLICIES["base-1"])) != 0,
            "kept": F.col("fail_bits").bitwiseAND(F.lit(POLICIES[version] | POLICIES["base-1"])) == 0,
            "policy": F.lit(version),
        }
    )


def ablations(found: DataFrame, version: str = CURRENT) -> DataFrame:
    """Per rule of a policy: rows that fail it, and rows that only it rejects (kept without it)."""
    policy = POLICIES[version]
    patterns = found.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy)).alias("bits")).count()
    rules = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(b).alias("bit")) for n, b in BITS.items() if b & policy]))
    each = patterns.select("bits", "count", rules.alias("r")).select("bits", "count", "r.*")
    total = lambda test: F.coalesce(F.sum(F.when(test, F.col("count"))), F.lit(0))
    return each.groupBy("rule").agg(
        total(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("failed"), total(F.col("bits") == F.col("bit")).alias("only_here")
    )


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Ledger of every document under the current policy."""
    return apply_policy(ledger(spark.read.parquet(f"{sf_dir}/documents.parquet")))


_UPPER = "length(regexp_replace(packed, '[^A-Z]', '', 'g'))"
SQL = rf"""
WITH base AS (
  SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT rid, unnest(range(len(words) - 7)) AS i, unnest(list_transform(range(len(words) - 7), lambda i: words[i + 1:i + 8])) AS w
  FROM base WHERE len(words) >= 8
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS j FROM twice) GROUP BY rid
), m AS (
  SELECT b.doc_id, len(words)::BIGINT AS n_words, array_to_string(words, '') AS packed, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM base b LEFT JOIN covered c USING (rid)
), n AS (
  SELECT * EXCLUDE (packed), length(packed)::BIGINT AS word_chars,
         length(regexp_replace(packed, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, {_UPPER}::BIGINT AS n_upper
  FROM m
), f AS (
  SELECT *, ({" + ".join(f"CASE WHEN {c} THEN {BITS[r]} ELSE 0 END" for r, c in RULES.items())})::INTEGER AS fail_bits FROM n
)
SELECT *, fail_bits & {POLICIES["base-1"]} <> 0 AS base_failed, fail_bits & {POLICIES[CURRENT]} = 0 AS kept, '{CURRENT}' AS policy FROM f
"""
