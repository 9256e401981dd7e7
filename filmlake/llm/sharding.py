"""Placement of rows on shards by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size, and
the shards take turns in claiming the next slot of theirs that is still free. All get the
same number of slots, give or take one, and few slots change hands when a shard comes or
goes. A row goes to the slot its key hashes to, and so to that slot's shard.

The table has ``SLOTS`` rows whatever the data, so it is broadcast. Rows with a NULL key are
placed by a hash of all their columns, so they do not gather on one shard; repeated rows go
to one shard; an empty table stays empty. Columns named ``slot`` or ``shard`` are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import blake2b

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# a prime, well over a hundred times the number of shards
SLOTS = 65_537


def _number(name: str, salt: str) -> int:
    return int.from_bytes(blake2b(f"{salt}:{name}".encode(), digest_size=8).digest(), "big")


def fill(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """For each slot the place of its shard in ``shards``."""
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shards must be distinct names, at least one and no more than slots")
    at = [_number(name, "offset") % slots for name in shards]
    skip = [_number(name, "skip") % (slots - 1) + 1 for name in shards]
    table = [-1] * slots
    left = slots
    while left:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % slots
            table[at[i]] = i
            left -= 1
            if not left:
                break
    return table


def lookup(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    rows = [(slot, shards[i]) for slot, i in enumerate(fill(shards, slots))]
    return spark.createDataFrame(rows, "slot long, shard string")


def place(df: DataFrame, key: str, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """All rows and columns of ``df`` with ``slot`` and ``shard``; no shuffle."""
    columns = [c for c in df.columns if c not in ("slot", "shard")]
    whole = F.xxhash64(*(F.col(c) for c in columns))
    hashed = F.when(F.col(key).isNull(), whole).otherwise(F.xxhash64(F.col(key).cast("string")))
    slotted = df.select(*columns, F.pmod(hashed, F.lit(slots)).alias("slot"))
    return slotted.join(F.broadcast(lookup(df.sparkSession, shards, slots)), "slot").select(*columns, "slot", "shard")


def write_shards(df: DataFrame, key: str, shards: Sequence[str], path: str, slots: int = SLOTS) -> None:
    """One folder per shard; each task adds its own file to it, so nothing is moved."""
    place(df, key, shards, slots).drop("slot").write.partitionBy("shard").parquet(path)
