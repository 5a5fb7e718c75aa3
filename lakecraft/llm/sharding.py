"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime
size (an offset and a step, both hashes of its name). The shards take turns;
each claims the first free slot in its order, until the table is full, so
shares differ by one slot at most per turn and a shard that joins or leaves
moves few other slots. A row's key is hashed to a slot, and the table, which
has a fixed size and is broadcast, gives the shard at once.

The main path is DataFrame functions only. The table holds ``size`` entries
whatever the data and is filled on the driver. Placement doesn't shuffle. One
key has one shard by definition, however many rows it has; rows are spread by
choosing a key that tells them apart (several columns are allowed).

Defined cases: null keys hash like any other value, so they share a shard;
repeated rows go together; empty tables stay empty; columns named like a
result are replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecraft.llm.tools import documents, without

SIZE = 65_537
SHARDS = 64


def fill(names: list[str], size: int = SIZE, weights: list[int] | None = None) -> list[int]:
    """Index of the shard that owns each slot. A shard of weight w takes w turns a round."""
    if not names or len(set(names)) != len(names):
        raise ValueError("shard names must be given and distinct")
    if size < 2 or any(size % d == 0 for d in range(2, int(size ** 0.5) + 1)):
        raise ValueError("the table size must be a prime number")
    weights = weights or [1] * len(names)
    if len(weights) != len(names) or min(weights) < 1:
        raise ValueError("one weight of at least 1 for each shard")
    at, step = [], []
    for name in names:
        digest = hashlib.sha256(name.encode()).digest()
        at.append(int.from_bytes(digest[:8], "big") % size)
        step.append(int.from_bytes(digest[8:16], "big") % (size - 1) + 1)
    owner = [-1] * size
    left = size
    while True:
        for shard, turns in enumerate(weights):
            for _ in range(turns):
                while owner[at[shard]] >= 0:
                    at[shard] = (at[shard] + step[shard]) % size
                owner[at[shard]] = shard
                left -= 1
                if not left:
                    return owner


def lookup(spark, owner: list[int]) -> DataFrame:
    """The table as rows (slot, shard)."""
    packed = F.split(F.lit(",".join(map(str, owner))), ",")
    return spark.range(1).select(F.posexplode(packed).alias("slot", "s")).select("slot", F.col("s").cast("int").alias("shard"))


def place(df: DataFrame, keys: list[str], names: list[str], size: int = SIZE, weights: list[int] | None = None) -> DataFrame:
    """``df`` plus slot and shard (index into ``names``) of each row's key."""
    table = F.broadcast(lookup(df.sparkSession, fill(names, size, weights)))      # ``size`` rows
    slot = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(size)).cast("int")
    return without(df.withColumn("_llm_slot", slot), "slot", "shard").join(table, F.col("_llm_slot") == F.col("slot")).drop("_llm_slot")


def op5_sharding(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` by id on 64 shards: doc_id, slot, shard."""
    docs = documents(spark, sf_dir).select("doc_id")
    return place(docs, ["doc_id"], [f"shard-{i:03d}" for i in range(SHARDS)])
