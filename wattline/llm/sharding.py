"""Operator 8: sharding by jump consistent hashing.

A row's shard is a pure function of its key and the number of shards: the key's
64-bit hash seeds a linear congruential generator whose jumps stop at the last
bucket below the shard count (Lamping and Veach, 2014). There is no ring table
and nothing to broadcast; appending one shard moves only rows into it.

Nulls: a null key is a key like any other (all null keys share a shard); a null
text has no bytes and the checksum of the empty string. Repeated keys share a
shard and get different slots. An empty table gives an empty result.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import bucket_offsets, stored, text_or_empty

#: Rows that share one ranking bucket of a shard, on average.
ROWS_PER_BUCKET = 20_000


def jump_hash(keys: np.ndarray, n_shards: int) -> np.ndarray:
    """Jump consistent hash of unsigned 64-bit keys into ``n_shards`` buckets."""
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    key = np.array(keys, dtype=np.uint64)
    shard = np.full(key.shape, -1, dtype=np.int64)
    jump = np.zeros(key.shape, dtype=np.int64)
    active = np.arange(key.size)
    with np.errstate(over="ignore"):
        while active.size:
            shard[active] = jump[active]
            key[active] = key[active] * np.uint64(2862933555777941757) + np.uint64(1)
            step = (key[active] >> np.uint64(33)).astype(np.float64) + 1.0
            jump[active] = ((shard[active] + 1) * (float(1 << 31) / step)).astype(np.int64)
            active = active[jump[active] < n_shards]
    return shard


def _jump(n_shards: int):
    def assign(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(dtype=np.int64).view(np.uint64), n_shards).astype(np.int32))
    return F.pandas_udf(assign, "int")


def assign_shards(rows: DataFrame, key: str, n_shards: int, out: str = "shard") -> DataFrame:
    """Add the shard of ``key``; any column type that ``xxhash64`` takes will do."""
    return rows.withColumn(out, _jump(n_shards)(F.xxhash64(F.col(key))))


def shard_documents(docs: DataFrame, n_shards: int = 24, key: str = "doc_id", text: str = "text",
                    ) -> DataFrame:
    """One row per document: key, size, text_crc32, law, shard, slot, grown_shard.

    ``slot`` numbers the rows of a shard from 0 without gaps. Ranks come from
    buckets of a shard (about ``ROWS_PER_BUCKET`` rows each) plus the counts
    of the buckets before, so no task holds a whole shard.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(text_or_empty(text)).cast("long") + 8).alias("size"),
        F.crc32(text_or_empty(text).cast("binary")).alias("text_crc32"))
    rows = assign_shards(rows, "doc_id", n_shards)
    rows = stored(assign_shards(rows, "doc_id", n_shards + 1, "grown_shard"), "shards")
    n_buckets = max(1, -(-rows.count() // (n_shards * ROWS_PER_BUCKET)))
    rows = rows.withColumn("__bucket", F.pmod(F.xxhash64("doc_id", "text_crc32", F.lit(8)), F.lit(n_buckets)))
    counts = rows.groupBy("shard", "__bucket").agg(F.count("*").alias("__n"))
    offsets = bucket_offsets(counts, ["shard"], "__bucket", "__n", "__before").drop("__n")
    w = Window.partitionBy("shard", "__bucket").orderBy("doc_id", "text_crc32", "size")
    ranked = rows.withColumn("__rank", F.row_number().over(w))
    return ranked.join(offsets, ["shard", "__bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("__before") + F.col("__rank") - 1).alias("slot"), "grown_shard")
