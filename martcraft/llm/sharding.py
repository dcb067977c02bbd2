"""Sharding by a permutation-filled lookup table.

Every shard has its own permutation of the slots of a prime-sized table (an
offset and a step from a hash of its name). The shards take turns, each
claiming its next free slot, ``weight`` slots a turn, until the table is full.
A document's slot is a hash of its id; the table, whose size is a parameter,
is broadcast, so a placement is one look-up, no document moves, and a shard
that joins or leaves changes few other placements.

A shard of weight 0 gets no slot; weights that are all 0, and a table with fewer
slots than shards, are refused.

Defined cases: a null id is placed as the empty text; equal ids land on the
same shard; an empty table gives an empty result; the texts are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martcraft.llm.common import carry

#: A prime, well above a hundred times the shards of the default plan.
TABLE_SIZE = 65_537
SHARDS = tuple(f"shard-{i:04d}" for i in range(256))


def _preference(shard: str, size: int) -> tuple[int, int]:
    digest = hashlib.sha256(shard.encode()).digest()
    return int.from_bytes(digest[:8], "big") % size, int.from_bytes(digest[8:16], "big") % (size - 1) + 1


def lookup_table(shards: tuple[str, ...] = SHARDS, size: int = TABLE_SIZE, weights: dict[str, int] | None = None) -> np.ndarray:
    """Slot -> position in ``shards``. The order of turns is that of the
    names, so the table does not depend on the order given."""
    if len(set(shards)) != len(shards) or not shards:
        raise ValueError("shards need distinct names, one at least")
    if size < len(shards):
        raise ValueError("the table needs a slot for each shard")
    if min((weights or {}).values(), default=1) < 0 or not any((weights or {}).get(s, 1) for s in shards):
        raise ValueError("weights must not be negative, and one shard at least needs a weight")
    if size < 3 or any(size % d == 0 for d in range(2, int(size ** 0.5) + 1)):
        raise ValueError("the table's size must be a prime")
    order = sorted(range(len(shards)), key=shards.__getitem__)
    prefer = [_preference(s, size) for s in shards]
    at = [p[0] for p in prefer]
    table = np.full(size, -1, np.int32)
    claimed = 0
    while claimed < size:
        for k in order:
            for _ in range((weights or {}).get(shards[k], 1)):
                if claimed == size:
                    break
                while table[at[k]] >= 0:
                    at[k] = (at[k] + prefer[k][1]) % size
                table[at[k]] = k
                claimed += 1
    return table


def slot(doc_id: str, size: int):
    return F.pmod(F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(size)).cast("int")


def place(docs: DataFrame, shards: tuple[str, ...] = SHARDS, size: int = TABLE_SIZE,
          weights: dict[str, int] | None = None, keep_row: bool = False) -> DataFrame:
    """doc_id (and the carried row), slot, shard (its position) and
    shard_name of every row."""
    table = lookup_table(shards, size, weights)
    rows = docs.sparkSession.createDataFrame(
        [(i, int(k), shards[k]) for i, k in enumerate(table)], "slot int, shard int, shard_name string")
    first = [carry(docs)] if keep_row else []
    placed = docs.select(*first, "doc_id", slot("doc_id", size).alias("slot"))
    return placed.join(F.broadcast(rows), "slot").select(
        *([c.name for c in placed.schema.fields if c.name not in ("slot",)]), "slot", "shard", "shard_name")


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder a shard; every task writes its own files."""
    placed.write.partitionBy("shard").parquet(path)
