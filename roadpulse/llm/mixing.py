"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

The words of a source lie in one line, document after document, cut into blocks of ``BLOCK``
words. A source takes its target exactly: blocks in the order of a keyed permutation, the last one
in part, and beyond one whole pass a second pass under another permutation, so no word is taken
more than twice. How many blocks of each source an output shard gets is drawn down a binary tree:
a node's quotas are split between its halves by a multivariate hypergeometric draw, which keeps
every source's total exact. The permuted blocks are then dealt out in order, so shards are
disjoint, and rows are ordered by a keyed hash inside a shard.

Nothing is ranked: a block's place follows from its number by a swap-or-not shuffle, a bijection
of [0, n). Documents stand in their line by a hash of id and text, and numbers come from running sums
per source and class of that hash, so a source with a third of all rows is spread over all classes.
One row per source, and one per source and class, are small tables. Draws are hashes too, so reruns
agree, however the rows were split or ordered.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import ROW, SPACES, WHOLE, let, numbered, one_spaced, whole_text, with_row_key

# The weights of the sources in code point order, repeating, and what they share.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_PASSES = 2

BLOCK = 256
SHARDS = 64
SEED = 20240131
# Least number of hash classes of a source's line, and rows to a class beyond it.
CLASSES = 1024
ROWS_PER_CLASS = 100_000
ROUNDS = 16
ATTEMPTS = 32


def word_count(text: Column) -> Column:
    """Number of runs without whitespace."""
    return let(
        F.btrim(one_spaced(text), F.lit(" ")),
        lambda t: F.when(F.octet_length(t) == 0, 0).otherwise(F.octet_length(t) - F.octet_length(F.replace(t, F.lit(" "))) + 1),
    ).cast("long")


def uniform(*key: Column) -> Column:
    """Draw from (0, 1), fixed by the key."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *key), 11).cast("double") + 0.5) / F.lit(float(1 << 53))


def permuted(n: Column, i: Column, *key: Column) -> Column:
    """Place of i under a keyed permutation of [0, n): swap-or-not rounds, each a bijection."""

    def swap(x: Column, r: Column) -> Column:
        shift = F.pmod(F.xxhash64(F.lit(SEED), F.lit("shift"), r, *key), n)
        other = F.pmod(shift - x, n)
        bit = F.xxhash64(F.lit(SEED), F.lit("bit"), r, F.greatest(x, other), *key).bitwiseAND(F.lit(1))
        return F.when(bit == 1, other).otherwise(x)

    return F.when(n > 1, F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), i.cast("long"), swap)).otherwise(i.cast("long"))


def log_factorial(x: Column) -> Column:
    """ln x! by Stirling's series at x + 8, brought back by the eight factors."""
    z = x.cast("double") + 8.0
    product = reduce(lambda a, k: a * (x + float(k)), range(2, 9), x + 1.0)
    return (z + 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3) - F.log(product)


def hypergeometric(good: Column, total: Column, draws: Column, *key: Column) -> Column:
    """Good ones among ``draws`` out of ``total``: ratio-of-uniforms rejection, first accepted attempt."""
    least, most = F.greatest(F.lit(0), draws - (total - good)), F.least(good, draws)
    mean = draws * good / total
    spread = F.sqrt(mean * (total - good) / total * (total - draws) / F.greatest(total - 1, F.lit(1)) + 0.5)
    # The constants of the table mountain hat.
    width = 1.7155277699214135 * spread + 0.8989161620588988
    mode = F.greatest(least, F.least(most, F.floor((draws + 1.0) * (good + 1.0) / (total + 2.0))))
    weight = lambda x: (
        log_factorial(x) + log_factorial(good - x) + log_factorial(draws - x) + log_factorial(total - good - draws + x)
    )
    found = let(
        F.struct(least.alias("least"), most.alias("most"), mean.alias("mean"), width.alias("width"), mode.alias("mode"), weight(mode).alias("top")),
        lambda c: F.coalesce(
            F.get(
                F.transform(
                    F.filter(
                        F.transform(
                            F.sequence(F.lit(1), F.lit(ATTEMPTS)),
                            lambda a: let(
                                F.struct(uniform(F.lit("u"), a, *key).alias("u"), uniform(F.lit("v"), a, *key).alias("v")),
                                lambda d: F.struct(
                                    F.floor(c["mean"] + 0.5 + c["width"] * (d["v"] - 0.5) / d["u"]).alias("x"), (2 * F.log(d["u"])).alias("bar")
                                ),
                            ),
                        ),
                        lambda d: F.when(d["x"].between(c["least"], c["most"]), d["bar"] <= c["top"] - weight(d["x"])).otherwise(F.lit(False)),
                    ),
                    lambda d: d["x"],
                ),
                F.lit(0),
            ),
            c["mode"],
        ),
    )
    return F.when(least == most, least).otherwise(found).cast("long")


def split_quotas(quotas: Column, draws: Column, node: Column) -> Column:
    """Multivariate hypergeometric draw of ``draws`` blocks from the quotas: source after source out of what is left."""
    zero = F.struct(
        F.aggregate(quotas, F.lit(0).cast("long"), lambda a, q: a + q).alias("left"), draws.cast("long").alias("need"),
        F.array().cast("array<bigint>").alias("out"),
    )

    def step(acc: Column, q: Column) -> Column:
        at = F.size(acc["out"])
        drawn = F.when(F.least(q, acc["need"]) == 0, F.lit(0).cast("long")).otherwise(hypergeometric(q, acc["left"], acc["need"], node, at))
        return let(
            drawn,
            lambda x: F.struct((acc["left"] - q).alias("left"), (acc["need"] - x).alias("need"), F.concat(acc["out"], F.array(x)).alias("out")),
        )

    return F.aggregate(quotas, zero, step, lambda acc: acc["out"])


def shard_starts(quotas: DataFrame, shards: int) -> DataFrame:
    """(at, starts): per source, the first draw that each shard gets. ``quotas`` holds (at, quota), at from 0; shards is a power of two."""
    row = quotas.agg(F.sort_array(F.collect_list(F.struct("at", "quota"))).alias("q")).select(F.col("q.quota").alias("quotas"), F.lit(0).alias("node"))
    for _ in range(shards.bit_length() - 1):
        total = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, q: a + q)
        row = row.withColumn("left", split_quotas(F.col("quotas"), F.floor((total + 1) / 2), F.concat_ws(":", F.lit(shards), "node", F.size("quotas"), total)))
        halves = F.array(
            F.struct(F.col("left").alias("quotas"), (2 * F.col("node")).alias("node")),
            F.struct(F.zip_with("quotas", "left", lambda q, x: q - x).alias("quotas"), (2 * F.col("node") + 1).alias("node")),
        )
        # One row per node, written level by level: the plan stays small, whatever the number of shards.
        row = cut_lineage(row.select(F.explode(halves).alias("h")).select("h.*"))
    each = row.select("node", F.posexplode("quotas").alias("at", "quota"))
    lists = each.groupBy("at").agg(F.sort_array(F.collect_list(F.struct("node", "quota"))).alias("q"))
    sums = F.aggregate(
        "q", F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("out")),
        lambda acc, x: F.struct((acc["sum"] + x["quota"]).alias("sum"), F.concat(acc["out"], F.array(acc["sum"])).alias("out")),
        lambda acc: acc["out"],
    )
    return lists.select("at", sums.alias("starts"))


def targets(sums: DataFrame) -> DataFrame:
    """Adds at (place of the source by code point, null last), weight and target to (source, source_size)."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("at") % len(WEIGHTS) + 1).cast("int"))
    ranked = sums.withColumn("at", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).withColumn("weight", weight)
    most = MOST_PASSES * F.col("source_size").cast("double")
    # One row per source: filled up in the order in which sources reach their limit.
    order = Window.orderBy(most / F.col("weight"), "at")
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = SHARE * F.sum("source_size").over(everything)
    level = (total - F.coalesce(F.sum(most).over(before), F.lit(0.0))) / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    filled = ranked.withColumn("level", level).withColumn("full", most <= F.col("level") * F.col("weight"))
    free = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    return filled.withColumn("target", F.when(F.col("full"), most).otherwise(free * F.col("weight"))).drop("level", "full")


def source_plan(sums: DataFrame, shards: int) -> DataFrame:
    """Per source: sizes, target, and for both passes the words wanted, the place of the short last block and the draws."""
    size, blocks = F.col("source_size"), F.col("n_blocks")
    base = targets(sums).withColumn("n_blocks", F.ceil(size / BLOCK)).withColumns(
        {"missing": blocks * BLOCK - size, "words_1": F.least(F.round("target").cast("long"), size)}
    ).withColumn("words_2", F.least(F.greatest(F.round("target").cast("long") - size, F.lit(0)), size))
    for k in (1, 2):
        words, short = F.col(f"words_{k}"), F.col(f"short_{k}")
        place = permuted(blocks, blocks - 1, F.col("at"), F.lit(k))
        base = base.withColumn(f"short_{k}", F.when(blocks > 0, place).otherwise(0)).withColumn(
            f"draws_{k}", F.when(words <= short * BLOCK, F.ceil(words / BLOCK)).otherwise(F.ceil((words + F.col("missing")) / BLOCK)).cast("long")
        )
    base = cut_lineage(base)
    starts = shard_starts(base.select("at", (F.col("draws_1") + F.col("draws_2")).alias("quota")), shards)
    return base.join(starts, "at")


def sized_documents(docs: DataFrame) -> DataFrame:
    """rid, doc_id, source, size, and the row's place in the line: a hash of id and text."""
    return with_row_key(
        docs, "doc_id", F.col("source").cast("string").alias("source"), word_count(whole_text()).alias("size"),
        F.xxhash64("doc_id", whole_text()).alias("line"),
    )


def planned(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Every row with its place in its source's line of words and its source's plan."""
    sized = cut_lineage(sized_documents(docs))
    classes = max(CLASSES, sized.count() // ROWS_PER_CLASS)
    sized = sized.withColumn("part", F.pmod("line", F.lit(classes)))
    parts = sized.groupBy("source", "part").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("base", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words")
    within = Window.partitionBy("source", "part").orderBy("line", "doc_id", "size", "rid").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    same_part = placed["source"].eqNullSafe(parts["source"]) & (placed["part"] == parts["part"])
    placed = placed.join(parts, same_part).select(
        placed["rid"], placed["doc_id"], placed["source"], placed["size"], (placed["inside"] + parts["base"]).alias("first")
    )
    plan = source_plan(sized.groupBy("source").agg(F.sum("size").alias("source_size")), shards)
    return placed.join(plan.withColumnRenamed("source", "s"), placed["source"].eqNullSafe(F.col("s"))).drop("s")


def drawn(plan: DataFrame) -> DataFrame:
    """One row per piece of a document in the mix: rid, doc_id, source, pass, block, shard, shuffle_key, word_start, words."""
    passes = F.explode(F.array(*[F.struct(F.lit(k).alias("pass"), *[F.col(f"{c}_{k}").alias(c) for c in ("words", "short", "draws")]) for k in (1, 2)]))
    pieces = (
        plan.filter("size > 0")
        .select("*", passes.alias("p"))
        .filter("p.words > 0")
        .select("*", F.explode(F.sequence(F.floor(F.col("first") / BLOCK), F.floor((F.col("first") + F.col("size") - 1) / BLOCK))).alias("block"))
        .withColumn("place", permuted(F.col("n_blocks"), F.col("block"), F.col("at"), F.col("p.pass")))
    )
    place, block = F.col("place"), F.col("block")
    words_before = place * BLOCK - F.when(place > F.col("p.short"), F.col("missing")).otherwise(0)
    block_end = F.least((block + 1) * BLOCK, F.col("source_size"), block * BLOCK + F.col("p.words") - words_before)
    start, end = F.greatest(block * BLOCK, F.col("first")), F.least(block_end, F.col("first") + F.col("size"))
    draw = F.when(F.col("p.pass") == 1, place).otherwise(F.col("draws_1") + place)
    return pieces.filter(end > start).select(
        "rid", "doc_id", "source", F.col("p.pass").alias("pass"), "block",
        (F.size(F.filter("starts", lambda s: s <= draw)) - 1).alias("shard"),
        F.xxhash64(F.lit(SEED), F.lit("shuffle"), "at", "p.pass", "block").alias("shuffle_key"),
        (start - F.col("first")).alias("word_start"), (end - start).alias("words"),
    )


def mix(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The mix, piece by piece, see :func:`drawn`; ``shards`` is a power of two. Order by shard and shuffle_key to write it.

    A null source is a source of its own, last in order; null or empty texts have no words and are not
    drawn; repeated rows are rows of their own; an empty table gives an empty mix.
    """
    return drawn(planned(docs, shards))


def taken_words(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per row of ``docs``: rid, doc_id, size, source_size, target, taken, and the shards that take words of it, in order."""
    plan = planned(docs, shards)
    sums = drawn(plan).groupBy("rid").agg(F.sum("words").alias("taken"), F.sort_array(F.collect_set("shard")).alias("shards"))
    return plan.select("rid", "doc_id", "size", "source_size", "target").join(sums, "rid", "left").withColumn(
        "taken", F.coalesce("taken", F.lit(0).cast("long"))
    ).withColumn("shards", F.coalesce("shards", F.array().cast("array<int>")))


def mixed_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The mix as documents with the columns of ``docs``: a row per document and pass with the words taken, n_chars set anew.

    A document that is taken whole keeps its text; otherwise the words keep the whitespace behind them.
    Rows without words are not in the mix; all columns stay, whatever their names; other cases as in :func:`mix`.
    """
    names = docs.columns
    docs = numbered(docs)
    pieces = mix(docs, shards).groupBy("rid", "pass").agg(F.sort_array(F.collect_list(F.struct("word_start", "words"))).alias("pieces"), F.sum("words").alias("n"))
    whole = F.col(f"{WHOLE}.text")
    words = F.regexp_extract_all(whole, F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    text = let(
        words,
        lambda w: F.when(F.size(w) == F.col("n"), whole).otherwise(
            F.array_join(F.flatten(F.transform("pieces", lambda p: F.slice(w, (p["word_start"] + 1).cast("int"), p["words"].cast("int")))), "")
        ),
    )
    joined = docs.join(pieces.select(F.col("rid").alias(ROW), "pieces", "n"), ROW).select(WHOLE, text.alias("mixed"))
    new = {"text": F.col("mixed"), "n_chars": F.char_length("mixed").cast("long")}
    return joined.select(*[new.get(c, F.col(WHOLE)[c]).alias(c) for c in names])


def op6_source_mixing(spark, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return taken_words(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("rid")
