"""Exact order statistics of a money column without gathering its values."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A decimal(12,2) has under 2^40 cents: at most 2^20 buckets of 2^20 values each.
BUCKET_BITS = 20


def _value_counts(frame: DataFrame, column: str) -> DataFrame:
    kind = frame.schema[column].dataType
    if not isinstance(kind, T.DecimalType) or kind.scale > 2 or kind.precision - kind.scale > 10:
        raise TypeError(f"{column} is {kind.simpleString()}: buckets are bounded for decimal(12,2) only")
    cents = (F.col(column) * 100).cast("long")
    return (
        frame.where(F.col(column).isNotNull())
        .groupBy(cents.alias("cents"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bucket", F.shiftright("cents", BUCKET_BITS))
    )


def _value_at(rank: str) -> Column:
    return F.min(F.when(F.col("seen") > F.col(rank), F.col("cents")))


def order_statistics(frame: DataFrame, column: str, fraction: Decimal) -> DataFrame:
    """One row: the two neighbours of the quantile and its share between them.

    Equal values collapse before the shuffle. A bounded histogram then names the
    one or two buckets that hold the ranks, and only their values are ordered.
    """
    counts = _value_counts(frame, column)
    running = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    position = F.lit(fraction) * (F.col("total") - 1)
    histogram = (
        counts.groupBy("bucket")
        .agg(F.sum("n").alias("bucket_rows"))
        .withColumn("through", F.sum("bucket_rows").over(running))
        .withColumn("total", F.sum("bucket_rows").over(Window.partitionBy()))
        .withColumn("before", F.col("through") - F.col("bucket_rows"))
        .withColumn("low_rank", F.floor(position).cast("long"))
        .withColumn("high_rank", F.ceil(position).cast("long"))
        .withColumn("share", (position - F.floor(position)).cast("double"))
    )
    holding = histogram.where(
        (F.col("through") > F.col("low_rank")) & (F.col("before") <= F.col("high_rank"))
    ).select(F.col("bucket").alias("held"), "before", "low_rank", "high_rank", "share")
    within = (
        Window.partitionBy("bucket")
        .orderBy("cents")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # Null-safe equality keeps both uses of ``counts`` identical, so its exchange is reused.
    inside = counts.join(
        F.broadcast(holding), F.col("bucket").eqNullSafe(F.col("held")), "inner"
    ).withColumn("seen", F.col("before") + F.sum("n").over(within))
    return inside.agg(
        _value_at("low_rank").alias("low_cents"),
        _value_at("high_rank").alias("high_cents"),
        F.max("share").alias("share"),
    )


def quantile(frame: DataFrame, column: str, fraction: Decimal) -> DataFrame:
    """One row, ``threshold``: the linearly interpolated quantile."""
    low, high = F.col("low_cents"), F.col("high_cents")
    return order_statistics(frame, column, fraction).select(
        ((low + (high - low) * F.col("share")) / 100.0).alias("threshold")
    )


def quantile_cutoff(frame: DataFrame, column: str, fraction: Decimal) -> DataFrame:
    """One row, ``cutoff``: the smallest value at or above the quantile, exact.

    Comparing with it is the same as comparing with the interpolated quantile.
    """
    return order_statistics(frame, column, fraction).select(
        (F.col("high_cents") * F.lit(Decimal("0.01"))).cast("decimal(14,2)").alias("cutoff")
    )
