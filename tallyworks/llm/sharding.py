"""Sharding by jump consistent hashing, and gapless row numbers without one big window."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.common import fresh
from tallyworks.session import splits

# Fixed value: the multiplier of the published jump consistent hash.
JUMP_MULTIPLIER = np.uint64(2862933555777941757)

# Starts of buckets, 16 bytes each, that are broadcast at most; more are joined by key.
BROADCAST_STARTS = 1 << 20


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key; from n to n + 1 shards keys only move to shard n."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.uint64)
    found = np.zeros(len(state), dtype=np.int64)
    moving = np.arange(len(state))
    jump = np.zeros(len(state), dtype=np.int64)
    while moving.size:
        found[moving] = jump
        state = state * JUMP_MULTIPLIER + np.uint64(1)
        step = float(2**31) / ((state >> np.uint64(33)).astype(np.float64) + 1.0)
        jump = ((found[moving] + 1) * step).astype(np.int64)
        inside = jump < shards
        moving, state, jump = moving[inside], state[inside], jump[inside]
    return found.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """Shard number of a long key, 0 to ``shards`` - 1. A null key counts as key 0.

    Declared as never null: else a join on it filters nulls, and the hash runs a second time for that.
    """

    @F.pandas_udf("int")
    def assign(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(dtype=np.int64).view(np.uint64), shards))

    return F.coalesce(assign(F.coalesce(key.cast("long"), F.lit(0).cast("long"))), F.lit(0))


def number_rows(
    rows: DataFrame, group: str, groups: int, order: Sequence[str], slot: str, buckets: int = 1024
) -> DataFrame:
    """Number the rows of each of the ``groups`` groups from 0 without gaps, in the column ``slot``.

    A group splits into ``buckets`` by the hash of the ordering columns; each
    bucket is numbered alone and starts where the earlier buckets' counts end.
    So no task needs a whole group; the starts of so many groups at most are
    broadcast, beyond that joined by key. Rows alike in every ordering column share a
    bucket and take its numbers in any order.
    """
    bucket, first, rank = fresh(rows, "bucket", "first", "rank")
    # Declared as never null, as the shard is: else the join hashes the order a second time.
    place = F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int")
    dealt = rows.withColumn(bucket, F.coalesce(place, F.lit(0)))
    before = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(group, bucket)
        .agg(F.count(F.lit(1)).alias(rank))
        .select(group, bucket, F.coalesce(F.sum(rank).over(before), F.lit(0)).alias(first))
    )
    inside = Window.partitionBy(group, bucket).orderBy(*order)
    return (
        dealt.withColumn(rank, F.row_number().over(inside) - 1)
        .join(F.broadcast(starts) if groups * buckets <= BROADCAST_STARTS else starts, [group, bucket])
        .withColumn(slot, (F.col(first) + F.col(rank)).cast("long"))
        .drop(bucket, first, rank)
    )


def shard_documents(documents: DataFrame, shards: int, key: str = "doc_id") -> DataFrame:
    """Every row of ``documents`` with its ``shard`` and its ``slot`` there.

    The key and the number of shards alone decide the shard. Columns that are
    already called shard or slot are replaced. A null key counts as key 0; rows
    with equal keys share a shard; null and empty texts and repeated rows are
    rows like any other; an empty table gives an empty result.
    """
    rows = documents.drop("shard", "slot").withColumn("shard", shard_of(F.col(key), shards))
    content = fresh(rows, "content")[0]
    others = [column for column in documents.columns if column not in ("shard", "slot")]
    rows = rows.withColumn(content, F.xxhash64(*others))
    return number_rows(rows, "shard", shards, [key, content], "slot").drop(content)


def shard_report(documents: DataFrame, shards: int) -> DataFrame:
    """Where each document goes and its size; each text is read once and never shuffled.

    The columns taken from the text are dealt out evenly first. The rows and the counts of the
    buckets read the same exchange, and no text passes the queue to the hash's Python worker.
    The result has a part for each split of ``documents`` at most: starting a file costs processes.
    ``size`` is the UTF-8 bytes of the text (null: none) plus 16; ``text_crc32``
    is null for a null text; ``grown_shard`` is the shard with one shard more.
    """
    content = F.col("text").cast("binary")
    narrow = documents.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(content).cast("long").alias("text_crc32"),
    )
    parts = min(splits(documents), int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = narrow.repartition(parts).select(
        "*",
        F.lit("key").alias("law"),
        shard_of(F.col("doc_id"), shards).alias("shard"),
        shard_of(F.col("doc_id"), shards + 1).alias("grown_shard"),
    )
    # All columns of the exchange: with fewer the counts would not share it.
    order = ["doc_id", "text_crc32", "size"]
    return number_rows(rows, "shard", shards, order, "slot").coalesce(parts)
