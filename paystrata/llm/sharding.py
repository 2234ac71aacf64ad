"""Sharding by a permutation-filled lookup table.

Every shard has an order of preference over the slots of a table of prime size: a start and a step, both from its name.
The shards take turns, each claiming the first slot of its order that is still free, until the table is full. So shards
hold almost equal numbers of slots, and when one goes, few slots of the others move. A key belongs to the slot of its
hash; the table has a fixed size and is broadcast, so placing a row takes one look-up, without a shuffle.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Slots of the table; a prime, more than a hundred times the number of shards.
SLOTS = 65_537


def _number(text: str) -> int:
    return int.from_bytes(hashlib.sha256(text.encode()).digest()[:8], "big")


def _prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def lookup_table(shards: list[str], slots: int = SLOTS) -> np.ndarray:
    """The shard (its place in ``shards``) of each slot. Equal lists of names give equal tables."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names")
    if not _prime(slots) or slots < len(shards):
        raise ValueError("the table needs a prime number of slots, as many as shards at least")
    offset = [_number(f"offset:{s}") % slots for s in shards]
    skip = [_number(f"skip:{s}") % (slots - 1) + 1 for s in shards]
    table = [-1] * slots
    at = offset[:]
    turns = sorted(range(len(shards)), key=lambda k: shards[k])     # the order of the names, not of the list
    filled = 0
    while True:
        for k in turns:
            while table[at[k]] >= 0:
                at[k] = (at[k] + skip[k]) % slots
            table[at[k]] = k
            filled += 1
            if filled == slots:
                return np.array(table, np.int32)


def slot_of(key_col: str, slots: int = SLOTS):
    """The slot of a key: its first 60 bits of md5, so any engine finds the same; a null key counts as an empty one."""
    digest = F.md5(F.coalesce(F.col(key_col).cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % slots).cast("int")


def place(docs: DataFrame, shards: list[str], key_col: str = "doc_id", slots: int = SLOTS, slot_name: str = "slot",
          shard_name: str = "shard") -> DataFrame:
    """``docs`` with the slot and the shard of each row's key.

    Equal keys, repeated rows among them, have one shard; null keys have one, too. An empty table gives no rows.
    """
    taken = {slot_name, shard_name} & set(docs.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} exist already")
    table = docs.sparkSession.createDataFrame(
        [(k, shards[s]) for k, s in enumerate(lookup_table(shards, slots).tolist())], f"{slot_name} int, {shard_name} string")
    placed = docs.withColumn(slot_name, slot_of(key_col, slots))
    return placed.join(F.broadcast(table), slot_name).select(*docs.columns, slot_name, shard_name)      # `slots` rows


def write_shards(docs: DataFrame, path: str, shards: list[str], key_col: str = "doc_id", slots: int = SLOTS) -> None:
    """Write each shard to a folder of its own. A shard that holds most rows is split over tasks, so over files."""
    placed = place(docs, shards, key_col, slots)
    placed.hint("rebalance", "shard").write.partitionBy("shard").mode("overwrite").parquet(path)
