"""Consistent sharding through a permutation-filled lookup table.

Each shard has a preference order of all slots of a table of prime size: an offset and a step from the hash of its
name. Shards take turns; each claims the first slot of its order that is free, until all are taken. A key's shard
is the table's entry at hash(key) modulo the size. The table has a fixed size whatever the data, so it is broadcast;
placing a row is one look-up with no shuffle. Shards get within a claim of the same number of slots, and taking
a shard away moves few keys of the others.

A null key counts as the empty text. Equal keys go to one shard, repeated rows too; keys are spread one by one, so a source
with a third of the rows lies on all shards. An empty table gives no rows. Columns are kept; the added ones are named by the caller.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table

#: The table is broadcast: no more slots than this.
MOST_SLOTS = 1 << 20


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], size: int) -> list[int]:
    """For each slot the number of the shard that claimed it."""
    if not _is_prime(size) or not len(shards) <= size <= MOST_SLOTS or not shards:
        raise ValueError(f"the table size must be a prime from the number of shards to {MOST_SLOTS}")
    digests = [hashlib.md5(name.encode()).hexdigest() for name in shards]
    offset = [int(d[:8], 16) % size for d in digests]
    step = [int(d[8:16], 16) % (size - 1) + 1 if size > 2 else 1 for d in digests]
    tried = [0] * len(shards)
    table = [-1] * size
    for turn in range(size):
        k = turn % len(shards)
        while table[slot := (offset[k] + tried[k] * step[k]) % size] >= 0:
            tried[k] += 1
        table[slot] = k
    return table


def slot_of(key: Column, size: int) -> Column:
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % size).cast("int")


def place(df: DataFrame, key: Column, shards: list[str], size: int, slot: str = "slot", shard: str = "shard") -> DataFrame:
    """The rows with the slot of their key and the name of its shard."""
    table = lookup_table(shards, size)
    entries = df.sparkSession.range(1).select(
        F.posexplode(F.split(F.lit(",".join(map(str, table))), ",")).alias("_slot", "_number"))
    names = F.split(F.lit("\n".join(shards)), "\n")
    entries = entries.select("_slot", F.get(names, F.col("_number").cast("int")).alias("_shard"))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), slot_of(key, size).alias("_slot"))
    return rows.join(F.broadcast(entries), "_slot").select(
        *[F.col("_row").getField(c).alias(c) for c in df.columns], F.col("_slot").alias(slot), F.col("_shard").alias(shard))


def write_shards(df: DataFrame, key: Column, shards: list[str], size: int, folder: str, tasks_per_shard: int = 4) -> None:
    """One folder per shard; each shard is written by several tasks, so none of them holds a whole shard."""
    rows = place(df, key, shards, size, "_shard_slot", "shard_name")
    spread = F.pmod(F.xxhash64(key.cast("string")), F.lit(tasks_per_shard))
    rows.repartition(len(shards) * tasks_per_shard, "shard_name", spread).drop("_shard_slot").write.partitionBy("shard_name").parquet(folder)


SHARDS = [f"shard-{k:02d}" for k in range(16)]
SLOTS = 2039


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document, 16 shards in a table of 2,039 slots."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    return place(docs, F.col("doc_id"), SHARDS, SLOTS)


ORACLE = f"""
WITH RECURSIVE shards AS (
    SELECT k, 'shard-' || lpad(k::VARCHAR, 2, '0') AS shard FROM range({len(SHARDS)}) r(k)
), orders AS (
    SELECT list(('0x' || md5(shard)[1:8])::BIGINT % {SLOTS} ORDER BY k) AS o,
           list(('0x' || md5(shard)[9:16])::BIGINT % {SLOTS - 1} + 1 ORDER BY k) AS s FROM shards
), fill(turn, taken, claimed) AS (
    SELECT 0, list_transform(range({SLOTS}), lambda x: false), -1::BIGINT
    UNION ALL
    SELECT turn + 1, list_transform(taken, lambda t, i: t OR i = slot + 1), slot FROM (
        SELECT turn, taken, list_filter(list_transform(range({SLOTS}), lambda j: (o[turn % {len(SHARDS)} + 1] + j * s[turn % {len(SHARDS)} + 1]) % {SLOTS}),
            lambda p: NOT taken[p + 1])[1] AS slot
        FROM fill, orders WHERE turn < {SLOTS})
)
SELECT doc_id, slot::INTEGER AS slot, shard FROM (
    SELECT doc_id, ('0x' || md5(coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT % {SLOTS} AS slot FROM documents)
JOIN (SELECT claimed AS slot, (turn - 1) % {len(SHARDS)} AS k FROM fill WHERE turn > 0) USING (slot) JOIN shards USING (k)
"""
