"""Placement of rows on shards by a permutation-filled lookup table.

Each shard has a preference order over the slots of a prime-sized table, from
two hashes of its name; shards take turns claiming the next free slot they
prefer.  A row's slot is its key's digest modulo the table size, so placement
is one join with a broadcast table whose size is a parameter, not the data's.
Adding or removing a shard moves few slots besides its own.

Defined cases: a null key is placed as the empty string; equal keys share a
shard; an empty table gives no rows; other columns pass through except those
named ``slot`` or ``shard``, which are replaced.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import shared_dir

#: Default table size, a prime; at most MAX_SLOTS, so that the broadcast stays below a few MB.
SLOTS = 1009
MAX_SLOTS = 655_373


def _number(text: str) -> int:
    return int(hashlib.sha256(text.encode()).hexdigest()[:15], 16)


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def fill(shards: list[str], slots: int = SLOTS) -> list[int]:
    """Slot -> position of its shard in ``shards``."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards need distinct names, one at least")
    if not _is_prime(slots) or not len(shards) <= slots <= MAX_SLOTS:
        raise ValueError(f"slots must be a prime from the number of shards to {MAX_SLOTS}")
    start = [_number(f"offset:{s}") % slots for s in shards]
    step = [_number(f"skip:{s}") % (slots - 1) + 1 if slots > 2 else 1 for s in shards]
    table, turn = [-1] * slots, [0] * len(shards)
    for k in range(slots):
        s = k % len(shards)
        while table[at := (start[s] + turn[s] * step[s]) % slots] >= 0:
            turn[s] += 1
        table[at] = s
    return table


def slot_of(key: Column, slots: int) -> Column:
    digest = F.sha2(F.coalesce(key.cast("string"), F.lit("")), 256)
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % F.lit(slots)).cast("int")


def lookup(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    return spark.createDataFrame([(i, shards[s]) for i, s in enumerate(fill(shards, slots))], "slot int, shard string")


def place(df: DataFrame, shards: list[str], key: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """``df`` with ``slot`` and ``shard``."""
    table = lookup(df.sparkSession, shards, slots)
    return df.drop("shard").withColumn("slot", slot_of(F.col(key), slots)).join(F.broadcast(table), "slot")


def write(placed: DataFrame, path: str, files_per_shard: int = 4) -> None:
    """One folder per shard, each written by ``files_per_shard`` tasks, among which its rows are spread by their hash."""
    spread = F.pmod(F.xxhash64(*[c for c in placed.columns if c != "shard"]), F.lit(files_per_shard))
    placed.repartition("shard", spread).write.partitionBy("shard").parquet(path)


def placed_files(docs: DataFrame, shards: list[str], key: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """Places and writes ``docs`` and reads them back, the shard from the folder's name; as many tasks write as the session shuffles to."""
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}"
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = place(docs, shards, key, slots)
    write(placed, path, max(1, -(-tasks // len(shards))))
    return spark.read.schema(placed.schema).parquet(path)
