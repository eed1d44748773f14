"""Sharding by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a table of prime size: it starts at a hash of its name and
goes on by a stride that is another hash. Shards take turns; each claims the first slot of its order that is still
free. Slots so differ by at most one between shards, and a shard that comes or goes moves few slots. A document's slot
is a hash of its key, its shard what the table has there: constant time, by a broadcast of SLOTS rows.

Defined results: a null key hashes like a value of its own; repeated keys share a shard; an empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SLOTS = 65_537  # prime, and the bound on what is broadcast
SHARDS = tuple(f"shard-{i:03d}" for i in range(256))


def digest(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8, person=salt.encode()).digest(), "little")


def prime(n: int) -> bool:
    return n > 1 and all(n % i for i in range(2, int(n**0.5) + 1))


def lookup(shards: Sequence[str], slots: int = SLOTS) -> np.ndarray:
    """The place in shards that each slot belongs to."""
    if not shards or len(set(shards)) < len(shards) or not prime(slots) or slots < len(shards):
        raise ValueError("shards must be distinct, and slots a prime number not below their number")
    at = [digest(s, "start") % slots for s in shards]
    stride = [digest(s, "stride") % (slots - 1) + 1 for s in shards]
    owner, left = [-1] * slots, slots
    while True:
        for i in range(len(shards)):
            while owner[at[i]] >= 0:
                at[i] = (at[i] + stride[i]) % slots
            owner[at[i]] = i
            left -= 1
            if not left:
                return np.array(owner)


def placed(docs: DataFrame, key: str = "doc_id", shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """key, slot, shard: one row per row of docs."""
    spark = docs.sparkSession
    rows = [(i, shards[o]) for i, o in enumerate(lookup(shards, slots).tolist())]
    where = F.broadcast(spark.createDataFrame(rows, "slot long, shard string"))
    hashed = F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("\0null")), F.lit(10)), F.lit(slots))
    return docs.select(docs[key], hashed.alias("slot")).join(where, "slot").select(key, "slot", "shard")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placed(table(spark, sf_dir, "documents"))
