"""Placement of documents on shards by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a table of prime
size, given by an offset and a skip that are hashes of its name. The shards take turns, each
claiming its most preferred slot that is still free, until the table is full, so
shards own equally many slots (within one) and adding or removing a shard moves
few of the others' slots. A document's key is hashed to a slot; looking the slot up
in the broadcast table (``size`` rows, a parameter) takes constant time.

A null key has a slot like any other value. Repeated keys share their slot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_SIZE = 65_537


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _name_hash(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{salt}/{name}".encode(), digest_size=8).digest(), "big")


def lookup_table(shards: Sequence[str], size: int = TABLE_SIZE) -> np.ndarray:
    """Number of the owning shard per slot. Names must differ; ``size`` must be prime."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards need distinct names, one at least")
    if not is_prime(size) or size < len(shards):
        raise ValueError("the table size must be a prime no smaller than the number of shards")
    place = [_name_hash(s, "offset") % size for s in shards]
    skip = [_name_hash(s, "skip") % max(size - 1, 1) + 1 for s in shards]
    owner = np.full(size, -1, np.int32)
    claimed = 0
    while True:
        for k in range(len(shards)):
            while owner[place[k]] >= 0:
                place[k] = (place[k] + skip[k]) % size
            owner[place[k]] = k
            claimed += 1
            if claimed == size:
                return owner


def table_frame(spark: SparkSession, shards: Sequence[str], size: int = TABLE_SIZE) -> DataFrame:
    """``slot, shard`` for every slot."""
    owner = lookup_table(shards, size)
    return spark.createDataFrame([(i, shards[k]) for i, k in enumerate(owner)], "slot INT, shard STRING")


def place_on_shards(
    rows: DataFrame, shards: Sequence[str], key: str = "doc_id", size: int = TABLE_SIZE
) -> DataFrame:
    """The rows' keys with their place: ``<key>, slot, shard``; no row is moved."""
    slot = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(size)).cast("int")
    table = table_frame(rows.sparkSession, shards, size)
    return (
        rows.select(F.col(key), slot.alias("slot"))
        .join(F.broadcast(table), "slot", "left")
        .select(key, "slot", "shard")
    )
