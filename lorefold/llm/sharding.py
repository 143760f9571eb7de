"""Placement of rows on shards by a permutation-filled lookup table.

Contract
* Every row goes to the shard that holds slot hash(key as string) mod table size; the table size is a
  prime. A null key is placed as the empty string; equal keys share a shard; an empty table gives no
  rows; other columns stay and may have any names but slot and shard, which are replaced.
* Every shard has a permutation of the slots from two hashes of its name. Shards take turns claiming
  their first free slot, so that slot counts differ by one at most (by weight, if weights are given);
  without one shard few slots of the others change hands.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Prime; the table of so many rows (12 bytes each) is what gets broadcast, whatever the size of the data.
TABLE_SIZE = 65537
SHARDS = tuple(f"shard-{i:03d}" for i in range(100))


def fill_table(shards, size: int = TABLE_SIZE, weights=None) -> np.ndarray:
    """The shard's index for every slot."""
    if size < 2 or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError(f"table size {size} is not a prime")
    if not shards or len(set(shards)) != len(shards) or len(shards) > size:
        raise ValueError("shards must be distinct, one at least and as many as slots at most")
    offset = [xxhash.xxh64_intdigest(s, seed=1) % size for s in shards]
    skip = [xxhash.xxh64_intdigest(s, seed=2) % (size - 1) + 1 for s in shards]
    turns = weights or [1] * len(shards)
    if min(turns) < 1:
        raise ValueError("weights are whole numbers from 1")
    out, at, left = [-1] * size, list(offset), size
    while True:
        for i, n in enumerate(turns):
            for _ in range(n):
                while out[at[i]] >= 0:
                    at[i] = (at[i] + skip[i]) % size
                out[at[i]] = i
                left -= 1
                if not left:
                    return np.array(out, np.int32)


def lookup(spark: SparkSession, shards, size: int = TABLE_SIZE, weights=None, name: str = "shard") -> DataFrame:
    slots = fill_table(shards, size, weights)
    return spark.createDataFrame([(i, shards[s]) for i, s in enumerate(slots.tolist())], f"slot int, {name} string")


def slot_of(col, size: int = TABLE_SIZE):
    return F.pmod(F.xxhash64(F.coalesce(F.col(col).cast("string"), F.lit(""))), F.lit(size)).cast("int")


def place(df: DataFrame, key: str, shards, size: int = TABLE_SIZE, weights=None) -> DataFrame:
    """df with slot and shard: one broadcast hash lookup a row, no shuffle."""
    keyed = df.drop("slot", "shard").withColumn("slot", slot_of(key, size))
    return keyed.join(F.broadcast(lookup(df.sparkSession, shards, size, weights)), "slot")


def write_shards(df: DataFrame, key: str, path: str, shards, writers_per_shard: int = 4) -> None:
    """Write df as one folder a shard; each shard is dealt to several writers."""
    placed = place(df, key, shards)
    salt = F.pmod(F.xxhash64("slot", F.monotonically_increasing_id()), F.lit(writers_per_shard))
    placed.repartition("shard", salt).write.partitionBy("shard").parquet(path)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document, and the one it would have without the last shard."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    placed = place(docs, "doc_id", SHARDS)
    return placed.join(F.broadcast(lookup(spark, SHARDS[:-1], name="shard_without_last")), "slot").select("doc_id", "n_chars", "slot", "shard", "shard_without_last")
