"""Sharding by a permutation-filled lookup table.

Every shard has its own permutation of the slots of a table of prime size
(offset and step from a digest of its name).  The shards take turns: on its
turn a shard claims the first slot of its permutation that is still free.
All shards end with the same number of slots to within one (with weights, in
proportion to them), and when shards come or go few slots change owner.

A key's slot is its hash modulo the table size; the shard is one lookup in
the broadcast table, whose size is the caller's prime (at most ``MAX_SLOTS``)
and does not depend on the data.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.llm.common import unused

SLOTS = 65_537
MAX_SLOTS = 1 << 20


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def _numbers(name: str, slots: int) -> tuple[int, int]:
    digest = hashlib.sha256(name.encode("utf-8")).digest()
    offset = int.from_bytes(digest[:8], "big") % slots
    step = int.from_bytes(digest[8:16], "big") % (slots - 1) + 1
    return offset, step


def fill_table(shards: Sequence[str], slots: int = SLOTS,
               weights: Sequence[float] | None = None) -> list[int]:
    """Owner (index into ``shards``) of every slot.

    The turns go round by name, so the order in which shards are listed does
    not matter.  A shard of weight w takes a turn whenever the turns it has
    had fall behind w times those of the heaviest.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be given and distinct")
    if not _is_prime(slots) or not len(shards) <= slots <= MAX_SLOTS:
        raise ValueError(f"slots must be a prime from the number of shards to {MAX_SLOTS}")
    weights = list(weights or [1.0] * len(shards))
    if len(weights) != len(shards) or min(weights) <= 0:
        raise ValueError("one positive weight per shard")
    top = max(weights)
    order = sorted(range(len(shards)), key=lambda i: shards[i])
    walk = [_numbers(s, slots) for s in shards]
    tried, credit, owner, left = [0] * len(shards), [0.0] * len(shards), [-1] * slots, slots
    while True:
        for i in order:
            credit[i] += weights[i] / top
            if credit[i] < 1 - 1e-9:
                continue
            credit[i] -= 1
            offset, step = walk[i]
            while owner[slot := (offset + tried[i] * step) % slots] >= 0:
                tried[i] += 1
            owner[slot] = i
            tried[i] += 1
            left -= 1
            if not left:
                return owner


def assign(docs: DataFrame, shards: Sequence[str], slots: int = SLOTS,
           weights: Sequence[float] | None = None, id_col: str = "doc_id",
           text_col: str | None = "text") -> DataFrame:
    """``doc_id, slot, shard``: one row per input row.

    The key is the id; a row without an id is placed by its text, so rows
    without ids spread as well (null text: as the empty text).  Repeated rows
    and repeated ids share a slot.  No shuffle: the table is broadcast (its
    size is bounded by ``MAX_SLOTS``).
    """
    spark = docs.sparkSession
    owners = fill_table(shards, slots, weights)
    lookup = spark.createDataFrame([(k, shards[o]) for k, o in enumerate(owners)], "slot int, shard string")
    by_text = F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) if text_col else F.lit(0).cast("long")
    key = F.xxhash64(F.coalesce(F.col(id_col).cast("long"), by_text))
    placed = docs.select(F.col(id_col).alias("doc_id"), F.pmod(key, F.lit(slots)).cast("int").alias("slot"))
    return placed.join(F.broadcast(lookup), "slot").select("doc_id", "slot", "shard")


def write_shards(docs: DataFrame, path: str, shards: Sequence[str], files_per_shard: int = 8,
                 slots: int = SLOTS, weights: Sequence[float] | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``docs`` as Parquet, one folder ``__shard=<name>`` per shard, all
    columns kept.  Each shard is dealt to ``files_per_shard`` tasks by slot,
    so no shard is one task's work."""
    if "__shard" in docs.columns:
        raise ValueError("__shard names the folders; rename the column of that name")
    owners = fill_table(shards, slots, weights)
    spark, [slot] = docs.sparkSession, unused(docs, "__slot")
    lookup = spark.createDataFrame([(k, shards[o]) for k, o in enumerate(owners)], f"{slot} int, __shard string")
    by_text = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    key = F.xxhash64(F.coalesce(F.col(id_col).cast("long"), by_text))
    placed = (docs.withColumn(slot, F.pmod(key, F.lit(slots)).cast("int"))
              .join(F.broadcast(lookup), slot))
    (placed.repartition(len(shards) * files_per_shard, "__shard", F.pmod(slot, F.lit(files_per_shard)))
     .drop(slot).write.partitionBy("__shard").parquet(path))
