"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size: it starts at
one slot and goes on by a fixed step. The shards take turns; each claims the first slot in its
order that is still free, until the table is full. So every shard owns the same number of slots,
give or take one, and when a shard comes or goes few slots change hands. A document's key is
hashed to a slot; the table, whose size is a parameter, is broadcast, and placement is one lookup.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = 32
# Prime, over a hundred slots a shard: shares differ by under one percent.
SLOTS = 4093
# Largest table: it is broadcast.
MOST_SLOTS = 1_000_003


def digest(text: str) -> int:
    """The number that :func:`slot_of` and the SQL form draw from a string."""
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """Owner, as a position in ``shards``, of every slot. ``slots`` is a parameter and bounds the work."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be named and distinct")
    if not is_prime(slots) or not len(shards) < slots <= MOST_SLOTS:
        raise ValueError(f"slots must be a prime over the number of shards and at most {MOST_SLOTS}")
    start = [digest(f"{s}:start") % slots for s in shards]
    step = [digest(f"{s}:step") % (slots - 1) + 1 for s in shards]
    owner = [-1] * slots
    free, turn = slots, 0
    while free:
        i = turn % len(shards)
        while owner[start[i]] >= 0:
            start[i] = (start[i] + step[i]) % slots
        owner[start[i]] = i
        free, turn = free - 1, turn + 1
    return owner


def table_frame(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """The lookup table as rows (slot, shard)."""
    owners = F.split(F.lit(",".join(map(str, lookup_table(shards, slots)))), ",")
    return spark.range(1).select(F.posexplode(owners).alias("slot", "owner")).select(
        F.col("slot").cast("long").alias("slot"), F.col("owner").cast("int").alias("shard")
    )


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key; a null key counts as the empty string."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % slots


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def place(rows: DataFrame, key: str, shards: list[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """``rows`` with slot and shard.

    Only the key decides, so rows of one key stay together and any run gives the same
    places. Null keys go to one slot, that of the empty string. Columns slot and shard
    of the input are replaced. The table has at most ``MOST_SLOTS`` rows of 12 bytes.
    """
    table = table_frame(rows.sparkSession, shards or shard_names(), slots)
    placed = rows.drop("slot", "shard") if key not in ("slot", "shard") else rows.withColumnRenamed(key, "__key").drop("slot", "shard")
    name = key if key in placed.columns else "__key"
    return placed.withColumn("slot", slot_of(F.col(f"`{name}`"), slots)).join(F.broadcast(table), "slot").drop("__key")


def write_shards(rows: DataFrame, key: str, path: str, shards: list[str] | None = None, parts: int = 1) -> None:
    """Parquet folders shard=0, 1, ... Each shard is written by up to ``parts`` tasks, so that none holds a whole one."""
    placed = place(rows, key, shards)
    salt = F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(parts))
    placed.repartition(F.col("shard"), salt).write.partitionBy("shard").parquet(path)


def op4_sharding(spark, sf_dir: str) -> DataFrame:
    """Slot and shard of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id")
    return place(docs, "doc_id").select("doc_id", "slot", "shard")


# The turns one by one: state is which slots are free.
SQL = f"""
WITH RECURSIVE shards AS (
  SELECT i, ('0x' || substr(md5(format('shard-{{:05d}}:start', i)), 1, 8))::BIGINT % {SLOTS} AS start,
         ('0x' || substr(md5(format('shard-{{:05d}}:step', i)), 1, 8))::BIGINT % {SLOTS - 1} + 1 AS step
  FROM range({SHARDS}) t(i)
), orders AS (
  SELECT list(list_transform(range({SLOTS}), lambda j: (start + j * step) % {SLOTS}) ORDER BY i) AS preferred FROM shards
), turns AS (
  SELECT 0::BIGINT AS turn, list_transform(range({SLOTS}), lambda j: true) AS free, NULL::BIGINT AS slot
  UNION ALL
  SELECT turn + 1, list_transform(free, lambda f, k: f AND k <> pick + 1), pick FROM (
    SELECT turn, free, list_filter(preferred[turn % {SHARDS} + 1], lambda s: free[s + 1])[1] AS pick
    FROM turns, orders WHERE turn < {SLOTS}
  )
), owners AS (SELECT slot, ((turn - 1) % {SHARDS})::INTEGER AS shard FROM turns WHERE turn > 0)
SELECT d.doc_id, o.slot, o.shard
FROM documents d JOIN owners o ON o.slot = ('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '')), 1, 8))::BIGINT % {SLOTS}
"""
