"""Sharding by jump consistent hashing: no ring table, and growth moves only what it must."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Multiplier of the generator in jump consistent hashing (a fixed value of the method).
MULTIPLIER = 2862933555777941757
#: Rows of a shard that one task numbers.
ROWS_PER_TASK = 1_000_000


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every 64-bit key, by jumps that skip ever more of the shard numbers."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    key = keys.astype(np.uint64)
    placed = np.zeros(len(key), dtype=np.int64)
    ahead = np.zeros(len(key), dtype=np.int64)
    moving = np.arange(len(key))
    while len(moving):
        placed[moving] = ahead[moving]
        key[moving] = key[moving] * np.uint64(MULTIPLIER) + np.uint64(1)
        share = ((key[moving] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        ahead[moving] = ((placed[moving] + 1) * (float(1 << 31) / share)).astype(np.int64)
        moving = moving[ahead[moving] < shards]
    return placed.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """Shard from 0 of a stable key; the same key and count always give the same shard.

    With one more shard a key stays or moves into the new shard. Null keys are one key.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")

    @F.pandas_udf("int")
    def place(mixed: pd.Series) -> pd.Series:
        return pd.Series(jump(mixed.to_numpy().astype(np.int64).view(np.uint64), shards))

    return place(F.xxhash64(key))


def shard_documents(
    df: DataFrame, shards: int, key: str = "doc_id", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Place documents by key and number the rows of every shard without gaps.

    Returns doc_id, size (UTF-8 bytes of the text and 1; 1 for null), text_crc32, law
    ('key'), shard, slot (from 0 in each shard) and grown_shard (with one more shard).
    Equal rows are counted before anything moves, so that a key repeated in any number of
    rows costs a task one row; a shard's rows are numbered in as many buckets as its size
    asks for. Rows alike in key, size and checksum are interchangeable, so the result is the
    same after a task is repeated. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = df.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    alike = ["doc_id", "size", "text_crc32"]
    counted = rows.groupBy(*alike).agg(F.count(F.lit(1)).alias("n_alike"))
    placed = counted.withColumn("shard", shard_of(F.col("doc_id"), shards)).withColumn(
        "grown_shard", shard_of(F.col("doc_id"), shards + 1)
    )
    total = df.count()
    buckets = max(1, math.ceil(total / shards / rows_per_task))
    split = placed.withColumn("bucket", F.pmod(F.xxhash64(*alike), F.lit(buckets)).cast("int"))
    # One row for each shard and bucket: a few thousand per billion rows.
    sums = split.groupBy("shard", "bucket").agg(F.sum("n_alike").alias("n_bucket"))
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sums.select(
        "shard", "bucket", F.coalesce(F.sum("n_bucket").over(earlier), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("shard", "bucket").orderBy(*alike).rowsBetween(
        Window.unboundedPreceding, -1
    )
    numbered = split.withColumn(
        "before", F.coalesce(F.sum("n_alike").over(inside), F.lit(0))
    ).join(starts, ["shard", "bucket"])
    first = F.col("start") + F.col("before")
    return numbered.select(
        *alike,
        F.lit("key").alias("law"),
        "shard",
        F.explode(F.sequence(first, first + F.col("n_alike") - 1)).alias("slot"),
        "grown_shard",
    )
