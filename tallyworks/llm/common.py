"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The character classes of the digest contracts.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh(frame: DataFrame, *names: str) -> list[str]:
    """Column names close to ``names`` that ``frame`` does not have yet."""
    taken = {column.lower() for column in frame.columns}
    chosen = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        chosen.append(name)
    return chosen


def hash_fraction(text: Column) -> Column:
    """A number in [0, 1) that the MD5 of ``text`` fixes: its first 52 bits."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(float(2**52))


def sampled(frame: DataFrame, column: str, count: int) -> Column:
    """Whether a value of ``column`` is among the ``count`` distinct ones of smallest 64-bit hash.

    All are if there are no more; copies count once. An estimate of the distinct values
    only bounds the hashes that are ordered: the bound is raised until enough are found.
    """
    hashed = F.xxhash64(column)
    hashes = frame.select(hashed.alias("hash"))
    values = frame.select(F.approx_count_distinct(column)).first()[0]
    span = 2**64 * 2 * count // max(1, values)
    while True:
        below = hashes.where(F.col("hash") <= min(span, 2**64) - 2**63 - 1).distinct()
        found, last = (
            below.orderBy("hash").limit(count).agg(F.count("hash"), F.max("hash")).first()
        )
        if found == count:
            return hashed <= last
        if span >= 2**64:
            return F.lit(True)
        span *= 8
