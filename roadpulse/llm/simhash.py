"""SimHash near-duplicates found through tables of pivot distances.

Pivots are reference fingerprints: the zero one and, for each of four groups of 16 bits, random
patterns inside the group. A fingerprint's table row holds its Hamming distances to all of them.
By the triangle inequality two fingerprints d bits apart differ by at most d in every coordinate,
so a pair with a larger coordinate difference is discarded, and only survivors are compared.

Pairs are not made from all rows. Two bits touch at most two groups; in the other two the
fingerprints agree, and there the distances to the group's pivots differ from the distance to the
zero pivot by equal amounts. These differences over two groups are the key of a table cell, so each
link is met in one of six cells. Equal fingerprints are one entry. A cell of up to ``CELL``
entries is joined with itself. Entries of fuller cells are linked without pairs: two fingerprints are
at most two bits apart exactly when flipping at most one bit of each gives a common value, so each
entry is hung on the least entry of its 65 values.

That is the query's rule. A pipeline stage wants near copies by similarity of their shingle sets. It takes the
links of the table's cells as candidates. Sets of the least similarity lie up to some twenty bits apart, though, where
no key of fingerprint bits is both selective and complete: further pairs come from bands of least shingle
hashes, and those whose fingerprints are over ``FAR`` bits apart are discarded. A crowded band has a pivot of its own, the
majority of its fingerprints, and its rows meet the rows nearest to that, and others by the rarest shingles of their
sets. Survivors have their shingle sets compared. Only rows that met another have their sets written.
"""

from __future__ import annotations

import random
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import ROW, WHOLE, numbered, rows_kept, stored, whole_text, with_row_key
from .components import components

SHINGLE = 3
SEED = 42
DISTANCE = 2
GROUPS = [[b for b in range(64) if b // 16 == g] for g in range(4)]
PIVOTS_PER_GROUP = 16
CELL = 64
# Shingles whose bits are counted at once.
CHUNK = 1 << 16

# Near copies by similarity: words of a shingle, and least Jaccard similarity.
WORDS = 5
SIMILARITY = 0.8
# A pair of similarity s shares a band with probability s ** BAND_ROWS.
BANDS = 16
BAND_ROWS = 4
# Sets of the similarity are further apart with a probability of 1.1e-6 at most (4 and 5 shingles, where a bit differs with 0.1875; counted for up to 90), of 1e-8 for large sets.
FAR = 28
# Entries of a fuller bucket are compared with so many of them, near its pivot, and by their rarest shingles with all others.
BUCKET = 32
HEADS = 4


def signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def pivots() -> list[list[int]]:
    """Patterns of each group of bits."""
    draw = random.Random(SEED)
    return [[signed(sum(1 << b for b in bits if draw.random() < 0.5)) for _ in range(PIVOTS_PER_GROUP)] for bits in GROUPS]


def shingle_hashes(text: str, shingle: int) -> Iterator[np.ndarray]:
    """Hashes of the word shingles of a whole text, in order and in chunks; none without words."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    if not words:
        return
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(shingle, len(words))
    n = len(words) - size + 1
    for at in range(0, n, CHUNK):
        spans = zip(starts[at : min(at + CHUNK, n)].tolist(), ends[at + size - 1 : min(at + CHUNK, n) + size - 1].tolist())
        yield np.array([xxh64_intdigest(line[s:e], SEED) for s, e in spans], "<u8")


def majority(chunks: Iterable[np.ndarray]) -> int:
    """The bits that more than half of the hashes have, as a signed number."""
    counts, n = np.zeros(64, np.int64), 0
    for hashes in chunks:
        n += len(hashes)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles of a whole text, as a signed number."""
    return majority(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame) -> DataFrame:
    """rid, doc_id and fp of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array([fingerprint(t.as_py()) for t in batch.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("doc_id"), fps], names=["rid", "doc_id", "fp"])

    base = with_row_key(docs, F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return base.mapInArrow(run, "rid long, doc_id long, fp long")


def distance(fp: Column, pivot: int) -> Column:
    return F.bit_count(fp.bitwiseXOR(F.lit(pivot)))


def table_row(fp: Column) -> Column:
    """Distances to all pivots."""
    return F.array(F.bit_count(fp), *[distance(fp, p) for group in pivots() for p in group])


def cells(fp: Column) -> Column:
    """Keys of the six cells: the differences to the zero pivot's distance over two groups."""
    to_zero, groups = F.bit_count(fp), pivots()
    return F.array(
        *[
            F.xxhash64(F.lit(k), *[distance(fp, p) - to_zero for g in pair for p in groups[g]])
            for k, pair in enumerate(combinations(range(len(GROUPS)), 2))
        ]
    )


def links(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints, enough to connect all that are at most DISTANCE bits apart."""
    keyed = distinct.select("fp", F.explode(cells(F.col("fp"))).alias("cell"))
    # Counts are written before they are joined: then AQE can split a crowded cell, value or fingerprint.
    shared = cut_lineage(keyed.groupBy("cell").count().filter("count > 1"))
    entries = cut_lineage(keyed.join(shared, "cell"))
    few = entries.filter(F.col("count") <= CELL).select("cell", "fp", table_row(F.col("fp")).alias("row"))
    pairs = few.select("cell", F.col("fp").alias("a"), F.col("row").alias("row_a")).join(
        few.select("cell", F.col("fp").alias("b"), F.col("row").alias("row_b")), "cell"
    )
    apart = F.array_max(F.zip_with("row_a", "row_b", lambda x, y: F.abs(x - y)))
    verified = pairs.filter(F.col("a") < F.col("b")).filter(apart <= DISTANCE).filter(
        F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE
    )
    crowded = entries.filter(F.col("count") > CELL).select("fp").distinct()
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(signed(1 << b))) for b in range(64)])
    spread = cut_lineage(crowded.select("fp", F.explode(flips).alias("value")))
    least = spread.groupBy("value").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    least = cut_lineage(least)
    hung = spread.join(least, "value").select(F.col("fp").alias("a"), "b")
    return verified.select("a", "b").union(hung).filter("a <> b").distinct()


def near_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: rid, doc_id, fingerprint, component_id, kept.

    ``component_id`` is the smallest doc_id reachable over links; null doc_ids count last and a
    group of these alone has none. ``kept`` marks one row of each group, that of the smallest
    doc_id. A null or empty text has the fingerprint zero and is linked like any other. An empty
    table gives no rows; other columns are not read.
    """
    marked = cut_lineage(fingerprints(docs))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("first")
    distinct = cut_lineage(marked.groupBy("fp").agg(first))
    joined = components(links(distinct)).withColumnRenamed("node", "fp")
    rooted = distinct.join(joined, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    best = rooted.groupBy("component").agg(F.min("first").alias("first"))
    of_fp = rooted.select("fp", "component").join(cut_lineage(best), "component").select(
        "fp", F.col("first.doc_id").alias("component_id"), F.col("first.rid").alias("keeper")
    )
    of_fp = cut_lineage(of_fp)
    return marked.join(of_fp, "fp").select(
        "rid", "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        (F.col("rid") == F.col("keeper")).alias("kept"),
    )


def band_keys(shingles: np.ndarray) -> list[int]:
    """One key per band: the band's number and its least values of the set under BAND_ROWS permutations. None for an empty set."""
    from xxhash import xxh64_intdigest

    if not len(shingles):
        return []
    draw = random.Random(SEED)
    odd = np.array([draw.getrandbits(64) | 1 for _ in range(BANDS * BAND_ROWS)], np.uint64)
    mask = np.array([draw.getrandbits(64) for _ in range(BANDS * BAND_ROWS)], np.uint64)
    least = np.full(len(odd), 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), CHUNK >> 4):
        least = np.minimum(least, ((shingles[at : at + (CHUNK >> 4), None] ^ mask) * odd).min(axis=0))
    rows = least.reshape(BANDS, BAND_ROWS).astype("<u8")
    return [signed(xxh64_intdigest(row.tobytes(), k)) for k, row in enumerate(rows)]


def sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """rid, doc_id, digest of the shingle set, its size, its fingerprint and its bands, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            rows = [(xxh3_128_digest(s.tobytes()), len(s), majority(s[at : at + CHUNK] for at in range(0, len(s), CHUNK)), band_keys(s)) for s in (shingle_set(t.as_py(), shingle) for t in batch.column("text"))]
            kinds = (pa.binary(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("doc_id"), *columns], names=["rid", "doc_id", "digest", "size", "fp", "bands"])

    base = with_row_key(docs, F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return base.mapInArrow(run, "rid long, doc_id long, digest binary, size int, fp long, bands array<long>")


def shingle_set(text: str, shingle: int) -> np.ndarray:
    """The distinct shingles of a whole text as sorted hashes."""
    chunks = list(shingle_hashes(text, shingle))
    return np.unique(np.concatenate(chunks)) if chunks else np.zeros(0, "<u8")


def sets_of(docs: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """node, shingles: the shingle set of each row whose key is in ``nodes``, made anew from its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingle_set(t.as_py(), shingle).view("<i8") for t in part.column("text")]
                yield pa.RecordBatch.from_arrays([part.column("rid"), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])

    texts = with_row_key(docs, whole_text().alias("text")).join(nodes.select(F.col("node").alias("rid")), "rid", "left_semi")
    return texts.mapInArrow(run, "node long, shingles array<long>")


def cell_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs of nodes (node, fp) whose fingerprints are linked in the cells of the pivot table. Each fingerprint is met through its least node."""
    least = cut_lineage(nodes.groupBy("fp").agg(F.min("node").alias("least")))
    same = nodes.join(least, "fp").select(F.col("least").alias("a"), F.col("node").alias("b"))
    linked = cut_lineage(links(least.select("fp")))
    apart = linked.join(least.toDF("a", "node_a"), "a").join(least.toDF("b", "node_b"), "b")
    return same.filter("a < b").union(apart.select(F.least("node_a", "node_b"), F.greatest("node_a", "node_b")))


def majority_of(fp: Column) -> Column:
    """The bits that more than half of a group's fingerprints have."""
    half = F.count(F.lit(1)) / 2
    bits = [F.when(F.sum(F.shiftrightunsigned(fp, b).bitwiseAND(F.lit(1))) > half, F.lit(signed(1 << b))).otherwise(F.lit(0)) for b in range(64)]
    return reduce(lambda x, y: x.bitwiseOR(y), bits)


def band_pairs(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of nodes (node, size, fp, bands) that share a band bucket of up to BUCKET entries; for fuller ones pairs with HEADS of their entries.

    Heads are the entries whose fingerprints are nearest to the bucket's pivot, the majority of its fingerprints: of copies of one
    text, each changed elsewhere, these are the text itself or the least changed, to which most others are linked.
    Also the nodes of the fuller buckets, whose other links are still to be found.
    """
    entries = nodes.select("node", "size", "fp", F.explode("bands").alias("bucket"))
    # Counts are written before they are joined: then AQE can split a crowded bucket.
    counts = cut_lineage(entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    shared = cut_lineage(entries.join(counts, "bucket"))
    few, full = shared.filter(F.col("n") <= BUCKET), shared.filter(F.col("n") > BUCKET)
    pivot = cut_lineage(full.groupBy("bucket").agg(majority_of(F.col("fp")).alias("pivot")))
    near = F.struct(F.bit_count(F.col("fp").bitwiseXOR(F.col("pivot"))).alias("bits"), "node", "size", "fp")
    heads = full.join(pivot, "bucket").groupBy("bucket", F.pmod(F.xxhash64("node"), F.lit(HEADS))).agg(F.min(near).alias("h"))
    heads = cut_lineage(heads.select("bucket", "h.*"))
    pairs = paired(few, few, "bucket").filter("a < b").union(paired(full, heads, "bucket").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    return pairs.filter("a < b").distinct(), full.select("node").distinct()


def paired(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(a, b) of one key whose sets are so alike in size, and fingerprints so near, that they can be linked."""
    left = left.select(key, F.col("node").alias("a"), F.col("size").alias("size_a"), F.col("fp").alias("fp_a"))
    right = right.select(key, F.col("node").alias("b"), F.col("size").alias("size_b"), F.col("fp").alias("fp_b"))
    alike = F.least("size_a", "size_b") >= F.lit(SIMILARITY - 1e-9) * F.greatest("size_a", "size_b")
    return left.join(right, key).filter(alike & (F.bit_count(F.col("fp_a").bitwiseXOR(F.col("fp_b"))) <= FAR)).select("a", "b")


def met_rows(rows: DataFrame, side: str) -> DataFrame:
    """Prefix rows as one side of a join on the shingle."""
    return rows.select("shingle", F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("size", "component", "behind")])


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs whose shingle sets have the similarity."""
    both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    return both.filter(common >= F.lit(similarity) * (F.size("set_a") + F.size("set_b") - common)).select("a", "b")


def prefix_pairs(sets: DataFrame, known: DataFrame, similarity: float) -> DataFrame:
    """Pairs of different components among ``sets`` (node, shingles) that can have the similarity, by their rarest shingles.

    Shingles are ranked by the number of sets that hold them. Of n shingles, the n - ceil(s n) + 1 rarest are the prefix; two
    sets of similarity s share a shingle of their prefixes, with enough shingles behind the first such one. Only rows of the most frequent component of a shingle are
    not met with each other, as they are linked already: every other row is met with all rows of the shingle.
    """
    spread = sets.select("node", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle"))
    counts = cut_lineage(spread.groupBy("shingle").agg(F.count(F.lit(1)).alias("f")).filter("f > 1"))
    # A shingle of one set only meets none, but comes first in the order.
    held = spread.join(counts, "shingle").groupBy("node", "size").agg(F.sort_array(F.collect_list(F.struct("f", "shingle"))).alias("common"))
    prefix = F.col("size") - F.ceil(F.lit(similarity - 1e-9) * F.col("size")) + 1 - (F.col("size") - F.size("common"))
    alone = F.col("size") - F.size("common")
    rows = held.select("node", "size", alone.alias("alone"), F.posexplode(F.slice("common", F.lit(1), F.greatest(prefix, F.lit(0)).cast("int"))).alias("at", "c"))
    rows = rows.select("node", "size", F.col("c.shingle").alias("shingle"), (F.col("size") - F.col("alone") - F.col("at") - 1).alias("behind"))
    rows = cut_lineage(rows.join(known, "node", "left").withColumn("component", F.coalesce("component", "node")))
    sizes = rows.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("shingle")
    largest = cut_lineage(sizes.agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all")).filter("all > top.n").select("shingle", F.col("top.component").alias("largest")))
    open_rows = cut_lineage(rows.join(largest, "shingle"))
    met = met_rows(open_rows.filter("component <> largest"), "a").join(met_rows(open_rows, "b"), "shingle")
    total = F.col("size_a") + F.col("size_b")
    # The first common shingle in the order leaves at most what stands behind it on either side.
    enough = 1 + F.least("behind_a", "behind_b") >= F.lit(similarity / (1 + similarity) - 1e-9) * total
    alike = F.least("size_a", "size_b") >= F.lit(similarity - 1e-9) * F.greatest("size_a", "size_b")
    return met.filter((F.col("component_a") != F.col("component_b")) & alike & enough).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def similar_groups(docs: DataFrame, shingle: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: rid, doc_id, fingerprint, component_id, kept, as in :func:`near_groups`, for another link.

    Two rows are linked when the Jaccard similarity of their sets of ``shingle`` words is at least
    ``similarity``, not below SIMILARITY; shingles are compared by 64-bit hash. ``fingerprint`` is the SimHash of the set.
    Linked pairs are looked for in the cells of the pivot table, which find those at most DISTANCE bits apart, and in bands,
    so one at the least similarity can be missed with a probability of some 0.0002; crowded bands lose none, as their
    rows are also met by their rarest shingles. No pair below the similarity is linked. Texts without words are equal.
    A null text is empty, repeated rows are one group, null ids count last, an empty table gives no rows.
    """
    docs = docs if docs.columns == [ROW, WHOLE] else numbered(docs.select("doc_id", "text"))
    marked = stored(sketches(docs, shingle), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("first")
    groups = cut_lineage(marked.groupBy("digest").agg(F.min("rid").alias("node"), first))
    # One row stands for each distinct set.
    nodes = marked.join(groups.select(F.col("node").alias("rid")), "rid", "left_semi").withColumnRenamed("rid", "node")
    pairs, crowded = band_pairs(nodes)
    pairs, crowded = cut_lineage(pairs.union(cell_pairs(nodes)).distinct()), cut_lineage(crowded)
    met = pairs.select(F.explode(F.array("a", "b")).alias("node")).union(crowded).distinct()
    sets = stored(sets_of(docs, met, shingle), "sets")
    linked = cut_lineage(verified(pairs, sets, similarity))
    known = cut_lineage(components(linked))
    more = prefix_pairs(sets.join(crowded, "node", "left_semi"), known, similarity)
    found = cut_lineage(verified(cut_lineage(more), sets, similarity))
    # What is linked already is a star for each component; only where links were added these are followed again.
    joined = known if found.isEmpty() else components(known.toDF("a", "b").union(found))
    rooted = groups.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rooted = cut_lineage(rooted)
    best = cut_lineage(rooted.groupBy("component").agg(F.min("first").alias("best")))
    of_set = rooted.join(best, "component").select("digest", F.col("best.doc_id").alias("component_id"), F.col("best.rid").alias("keeper"))
    return marked.select("rid", "doc_id", "fp", "digest").join(cut_lineage(of_set), "digest").select(
        "rid", "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", (F.col("rid") == F.col("keeper")).alias("kept")
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of :func:`similar_groups`, all columns as they were, whatever their names."""
    docs = numbered(docs)
    return rows_kept(docs, similar_groups(docs).filter("kept"))


def op5_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("rid", "kept")
