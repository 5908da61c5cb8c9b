"""Exact dedup by deterministic block naming.

A text becomes fixed-size blocks of bytes. Sorting the blocks gives every distinct block an
integer name; then adjacent names are paired and every distinct pair is named, again and
again, until one name is left per document. Names stand for contents, never for hashes, so
two documents of as many blocks have one name exactly when their texts are equal.

The name of a content is the number of one of its occurrences (the least), hence it needs no
numbering across tasks. Block texts are shuffled once. A block may be in a third of all
documents: the most frequent block fingerprints are found first, their (at most
``HOT_BLOCKS``) texts are named apart and looked up before the shuffle, which leaves no key
with more than 1/``HOT_BLOCKS`` of the blocks. Pairs are two integers; they are
counted by partial aggregates and joined back, where AQE splits a large key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import numbered, one_spaced, rows_kept, whole_text, with_row_key

BLOCK_BYTES = 4096
HOT_BLOCKS = 1000
# A fingerprint below so many occurrences is not worth a lookup.
HOT_COUNT = 64
NO_RIGHT = -(2**63)


def block_rows(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of the normalised texts: rid, doc_id, n_blocks, text_sha256 (first block only), pos, block, fp."""
    base = with_row_key(docs, F.col("doc_id"), one_spaced(whole_text()).alias("text"))
    data = F.col("text").cast("binary")
    blocks = F.transform(
        F.sequence(F.lit(0), F.col("n_blocks") - 1),
        lambda i: F.substring(data, i * block_bytes + 1, F.lit(block_bytes)),
    )
    return (
        base.withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.octet_length("text") / block_bytes)).cast("int"))
        .select("rid", "doc_id", "n_blocks", F.sha2("text", 256).alias("sha"), F.posexplode(blocks).alias("pos", "block"))
        .select(
            "rid", "doc_id", "n_blocks", F.when(F.col("pos") == 0, F.col("sha")).alias("text_sha256"), "pos", "block",
            F.xxhash64("block").alias("fp"),
        )
    )


def hot_names(rows: DataFrame) -> DataFrame:
    """Names below zero for the texts of the most frequent blocks, in sorted order.

    Any block with over 1/HOT_BLOCKS of all occurrences is among them.
    """
    hot = rows.groupBy("fp").count().filter(F.col("count") >= HOT_COUNT).orderBy(F.desc("count"), "fp").limit(HOT_BLOCKS)
    texts = rows.join(F.broadcast(hot.select("fp")), "fp").groupBy("fp", "block").agg(F.count(F.lit(1)).alias("n"))
    few = texts.orderBy(F.desc("n"), "fp", "block").limit(HOT_BLOCKS)
    return few.select("fp", "block", (-F.row_number().over(Window.orderBy("block"))).cast("long").alias("hot_name"))


def named_blocks(rows: DataFrame) -> DataFrame:
    """Every block row with the integer name of its content instead of the content."""
    with_hot = rows.join(F.broadcast(hot_names(rows)), ["fp", "block"], "left").withColumn(
        "occurrence", F.monotonically_increasing_id()
    )
    cold = F.col("hot_name").isNull()
    same = Window.partitionBy("block", "alone")
    return (
        with_hot.withColumns({"block": F.when(cold, F.col("block")), "alone": F.when(~cold, F.col("occurrence"))})
        .withColumn("name", F.coalesce("hot_name", F.min("occurrence").over(same)))
        .select("rid", "doc_id", "n_blocks", "text_sha256", "pos", "name")
    )


def named_documents(blocks: DataFrame) -> DataFrame:
    """One name per document with more than one block: rid, name. Pairs of names are named until one is left."""
    current = blocks.filter("n_blocks > 1").select("rid", "pos", "name")
    most = current.agg(F.max("pos")).first()[0]
    for _ in range(int(most or 0).bit_length()):
        side = F.col("pos") % 2
        pairs = current.groupBy("rid", F.shiftright("pos", 1).alias("pos")).agg(
            F.max(F.when(side == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(side == 1, F.col("name"))), F.lit(NO_RIGHT)).alias("right"),
        )
        # Written before use: the numbers of the occurrences are drawn once.
        pairs = cut_lineage(pairs.withColumn("occurrence", F.monotonically_increasing_id()))
        names = cut_lineage(pairs.groupBy("left", "right").agg(F.min("occurrence").alias("name")))
        current = pairs.join(names, ["left", "right"]).select("rid", "pos", "name")
    return current.select("rid", "name")


def exact_groups(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: rid, doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are after each run of whitespace became one space; null counts
    as the empty text. Of equal texts the smallest doc_id stays, a null one only if there is no
    other; of several rows with that id exactly one. An empty table gives no rows. Other
    columns of ``docs``, whatever their names, are not read.
    """
    blocks = cut_lineage(named_blocks(block_rows(docs, block_bytes)))
    heads = blocks.filter("pos = 0")
    one = heads.filter("n_blocks = 1").drop("pos")
    many = heads.filter("n_blocks > 1").drop("pos", "name").join(named_documents(blocks), "rid")
    known = one.unionByName(many)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("first")
    # Written before it is joined: then AQE can split a group of very many copies.
    groups = cut_lineage(known.groupBy("n_blocks", "name").agg(first, F.count(F.lit(1)).alias("group_size")))
    return known.join(groups, ["n_blocks", "name"]).select(
        "rid", "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("first.rid")).alias("kept"), "text_sha256",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without copies, all columns as they were, whatever their names.

    Nulls, ties, repeated rows and empty tables are treated as in :func:`exact_groups`.
    """
    docs = numbered(docs)
    return rows_kept(docs, exact_groups(docs).filter("kept"))


def op1_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Group, keeper and normalised digest of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_groups(docs).drop("rid")


SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""
