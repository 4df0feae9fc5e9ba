"""Key lookups that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.session import bytes_setting, input_bytes

# Limits of the frequent-items sketch: items tracked at least, and at most.
MIN_TRACKED = 4_096
MAX_TRACKED = 65_536

# Stored bytes of the input that one partition of a shuffle join takes: some 20 times that as rows.
PARTITION_BYTES = 4 * 2**20
# Frames that no file backs have no known size; the optimizer says 2^63.
UNKNOWN_BYTES = 2**60


def shuffle_partitions(frame: DataFrame) -> int:
    return max(int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)


def join_partitions(fact: DataFrame) -> int:
    """Partitions that stay small enough to sort and group in memory, however large the input."""
    stored = input_bytes(fact)
    fitting = 0 if stored >= UNKNOWN_BYTES else math.ceil(stored / PARTITION_BYTES)
    return max(shuffle_partitions(fact), min(fitting, MAX_TRACKED // 4))


def hot_keys(fact: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """(key, salts): keys that alone would overfill an average shuffle partition.

    There can be no more of them than partitions. A mergeable sketch finds them
    in one column scan without a shuffle by key, and ``salts`` is the number of
    partitions' worth of rows a key has. It only decides where rows go: a key it
    misses is joined like any other.
    """
    partitions = partitions or shuffle_partitions(fact)
    tracked = min(max(MIN_TRACKED, 4 * partitions), MAX_TRACKED)
    # Splits' sketches merge in groups first, so that no task receives all of them.
    groups = max(2, math.isqrt(partitions))
    merged = (
        fact.where(F.col(key).isNotNull())
        .groupBy(F.pmod(F.spark_partition_id(), F.lit(groups)).alias("sketch_group"))
        .agg(
            F.expr(f"approx_top_k_accumulate({key}, {tracked})").alias("sketch"),
            F.count(F.lit(1)).alias("keyed_rows"),
        )
        # grouped, because merging cannot begin in a task that has no sketch at all
        .groupBy(F.lit(0).alias("all"))
        .agg(
            F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"),
            F.sum("keyed_rows").alias("keyed_rows"),
        )
    )
    load = F.col("entry.count") * partitions / F.col("keyed_rows")
    return (
        merged.where(F.col("keyed_rows") > 0)
        .select("keyed_rows", F.expr(f"explode(approx_top_k_estimate(sketch, {partitions}))").alias("entry"))
        .where(load >= 1)
        .select(F.col("entry.item").alias(key), (F.ceil(load) + 1).cast("int").alias("salts"))
    )


def salted_lookup(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    how: str,
    spread_by: Sequence[str | Column],
    keys_from: DataFrame | None = None,
    keep_salt: bool = False,
) -> DataFrame:
    """Shuffle join on (key, salt).

    Rows of a hot key spread over as many partitions as they would fill, and the
    dimension rows they match are repeated once per salt. Null keys match
    nothing, so they spread over all partitions. With ``keep_salt`` the column stays: grouping by
    the key, the salt and more needs no other shuffle.
    """
    keyed = fact if keys_from is None else keys_from
    partitions = join_partitions(keyed)
    hot = F.broadcast(hot_keys(keyed, key, partitions))
    spread = F.xxhash64(*spread_by)
    row_salt = (
        F.when(F.col(key).isNull(), F.pmod(spread, F.lit(partitions)))
        .when(F.col("salts").isNotNull(), F.pmod(spread, F.col("salts")))
        .otherwise(F.lit(0))
    )
    salted_fact = (
        fact.join(hot, key, "left").withColumn("salt", row_salt.cast("int")).drop("salts")
    )
    every_salt = F.sequence(F.lit(0), F.coalesce(F.col("salts") - 1, F.lit(0)))
    salted_dimension = (
        dimension.join(hot, key, "left").withColumn("salt", F.explode(every_salt)).drop("salts")
    )
    if partitions > shuffle_partitions(fact):
        salted_fact = salted_fact.repartition(partitions, key, "salt")
    joined = salted_fact.join(salted_dimension, [key, "salt"], how)
    return joined if keep_salt else joined.drop("salt")


def lookup(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    spread_by: Sequence[str | Column],
    keys_from: DataFrame | None = None,
    keep_salt: bool = False,
) -> DataFrame:
    """Left join: broadcast ``dimension`` while it is small, else shuffle with salt.

    ``keys_from`` is a frame with the same keys that is cheaper to scan than
    ``fact``, which may itself be the result of joins.
    """
    if is_small(dimension):
        joined = fact.join(F.broadcast(dimension), key, "left")
        return joined.withColumn("salt", F.lit(0)) if keep_salt else joined
    return salted_lookup(fact, dimension, key, "left", spread_by, keys_from, keep_salt)


def lookup_grouped(groups: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Left join onto rows already grouped by ``key`` and at most the month.

    Grouping has bounded the rows per key, so no key can be hot.
    """
    if is_small(dimension):
        return groups.join(F.broadcast(dimension), key, "left")
    return groups.join(dimension, key, "left")


def is_small(dimension: DataFrame) -> bool:
    limit = bytes_setting(dimension.sparkSession, "spark.sql.autoBroadcastJoinThreshold")
    return input_bytes(dimension) <= limit
