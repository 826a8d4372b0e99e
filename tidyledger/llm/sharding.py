"""Sharding by a permutation-filled lookup table.

Each shard has a preference order of the slots of a table of prime size: it starts at an offset and moves on by a skip,
both from a hash of the shard's name. The shards take turns; each claims the first slot of its order that is free.
When a shard is added or taken away, few other slots change hands. A row's key is hashed to a slot; the table is
broadcast (its size is a parameter), so placing a row takes constant time and no shuffle.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = 64
SLOTS = 6553  # prime, about a hundred slots per shard


def shard_names(shards: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(shards)]


def fill(names: list[str], slots: int) -> list[int]:
    """The owner of each slot. ``slots`` is at most a few million, so this takes seconds and no data."""
    if not names or slots < max(2, len(names)) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime number that is not below the number of shards, and there must be a shard")
    number = lambda part, name: int(hashlib.md5(f"{part}:{name}".encode()).hexdigest()[:13], 16)
    at = [number("offset", n) % slots for n in names]
    skip = [number("skip", n) % (slots - 1) + 1 for n in names]
    owner, free = [-1] * slots, slots
    while True:
        for shard in range(len(names)):
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + skip[shard]) % slots
            owner[at[shard]] = shard
            free -= 1
            if not free:
                return owner


def lookup_table(spark: SparkSession, names: list[str], slots: int) -> DataFrame:
    """(_slot, _shard), one row per slot."""
    owners = F.split(F.lit(",".join(map(str, fill(names, slots)))), ",")
    table = spark.range(0, 1, 1, 1).select(F.posexplode(owners).alias("_slot", "_shard"))
    return table.select(F.col("_slot").cast("bigint").alias("_slot"), F.col("_shard").cast("int").alias("_shard"))


def slot(id_col: str, text_col: str | None, slots: int) -> Column:
    """The row's slot. A row without an id goes by its text, so that such rows spread; without both, by ''."""
    key = F.col(id_col).cast("string")
    if text_col is not None:
        key = F.coalesce(key, F.concat(F.lit("text:"), F.md5(F.col(text_col).cast("binary"))))
    key = F.coalesce(key, F.lit(""))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("bigint") % F.lit(slots)


def shard(
    docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, id_col: str = "doc_id", text_col: str | None = "text",
    slot_as: str = "slot", shard_as: str = "shard",
) -> DataFrame:
    """Every row of ``docs`` with its slot and shard; columns of these names in ``docs`` are replaced.

    Equal ids go to one shard, repeated rows too. A NULL or empty text is no special case. An empty table gives an
    empty result.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in (slot_as, shard_as)]
    rows = docs.select(F.struct(*kept).alias("row"), slot(f"`{id_col}`", text_col and f"`{text_col}`", slots).alias("_slot"))
    table = F.broadcast(lookup_table(docs.sparkSession, shard_names(shards), slots))
    return rows.join(table, "_slot", "left").select("row.*", F.col("_slot").alias(slot_as), F.col("_shard").alias(shard_as))


def write_shards(docs: DataFrame, path: str, files_per_shard: int = 1, shard_as: str = "shard", **options) -> None:
    """One folder per shard. ``files_per_shard`` splits each by a hash of the row, so no task holds a whole shard."""
    placed = shard(docs, shard_as=shard_as, **options)
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]), F.lit(files_per_shard))
    placed.repartition(shard_as, salt).write.partitionBy(shard_as).mode("overwrite").parquet(path)
