"""Monthly revenue series: features, moving-average forecast, future months.

A series frame has the columns series, period, year, month, quarter, revenue
(decimal). Every window partitions by series, and a series holds one row per
calendar month, so no partition can outgrow a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tallyworks.functions.calendar import (
    month_start,
    period,
    period_start,
    season_cosine,
    season_sine,
)
from tallyworks.functions.rounding import half_even

REVENUE = "decimal(18,2)"


def by_period() -> WindowSpec:
    return Window.partitionBy("series").orderBy("period")


def whole_series() -> WindowSpec:
    return Window.partitionBy("series")


def total_series(monthly: DataFrame) -> DataFrame:
    """The single overall series of a monthly summary, as stored or as built."""
    return monthly.select(
        F.lit("total").alias("series"),
        "period",
        F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"),
        F.col("quarter").cast("int").alias("quarter"),
        F.col("total_revenue").cast(REVENUE).alias("revenue"),
    )


def keyed_series(sales: DataFrame, *keys: str) -> DataFrame:
    """One series per combination of ``keys``, named by joining them with '/'.

    A '/' or backslash inside a key is preceded by a backslash, so that different
    keys have different names.

    Without keys there is one series, ``total``.
    ``sales`` has year, month, the keys and revenue: a summary, or ledger rows
    without the returned ones.
    """
    start = month_start(F.col("year"), F.col("month"))
    parts = [F.regexp_replace(F.col(key).cast("string"), r"([/\\])", r"\\$1") for key in keys]
    name = F.concat_ws("/", *parts) if keys else F.lit("total")
    return (
        sales.dropna(subset=["year", "month", *keys])
        .groupBy(*keys, "year", "month")
        .agg(F.sum("revenue").cast(REVENUE).alias("revenue"))
        .select(
            name.alias("series"),
            period(start).alias("period"),
            "year",
            "month",
            F.quarter(start).alias("quarter"),
            "revenue",
        )
    )


def trailing_mean(width: int) -> Column:
    frame = by_period().rowsBetween(1 - width, Window.currentRow)
    return F.sum("revenue").over(frame).cast("double") / F.count("revenue").over(frame)


def with_features(series: DataFrame) -> DataFrame:
    """Position, trailing means, lags and season columns of each month."""
    return series.withColumns(
        {
            "t": F.row_number().over(by_period()) - 1,
            "ma_3": trailing_mean(3),
            "ma_6": trailing_mean(6),
            "lag_1": F.lag("revenue", 1).over(by_period()).cast("double"),
            "lag_3": F.lag("revenue", 3).over(by_period()).cast("double"),
            "sin_month": season_sine(F.col("month")),
            "cos_month": season_cosine(F.col("month")),
            "quarter_enc": F.col("quarter"),
        }
    )


def with_split(features: DataFrame, train_share: float = 0.80) -> DataFrame:
    """Complete rows only; the first share of each series trains, the rest tests."""
    complete = features.dropna()
    rows = F.count(F.lit(1)).over(whole_series())
    place = F.row_number().over(by_period()) - 1
    return complete.withColumn("is_train", place < F.floor(rows * F.lit(train_share)))


def _mean(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda a, b: a + b)
    return total / F.size(values)


def _last(values: Column, width: int) -> Column:
    start = F.greatest(F.size(values) - F.lit(width - 1), F.lit(1))
    return F.slice(values, start, F.lit(width))


def moving_average_forecast(series: DataFrame, window: int = 3, horizon: int = 6) -> DataFrame:
    """(series, step, period, ma_forecast): each mean feeds the next, unrounded."""
    month = F.struct("period", F.col("revenue").cast("double").alias("revenue"))
    known = series.groupBy("series").agg(
        F.array_sort(F.collect_list(month)).alias("months"),
        F.max("period").alias("last_period"),
    )
    history = F.transform("months", lambda m: m["revenue"])
    return (
        known.withColumn("recent", _last(history, window))
        .withColumn(
            "extended",
            F.aggregate(
                F.sequence(F.lit(1), F.lit(horizon)),
                F.col("recent"),
                lambda grown, _: F.concat(grown, F.array(_mean(_last(grown, window)))),
            ),
        )
        .select(
            "series",
            "last_period",
            F.posexplode(F.slice("extended", F.size("recent") + 1, F.lit(horizon))).alias(
                "index", "value"
            ),
        )
        .select(
            "series",
            (F.col("index") + 1).alias("step"),
            future_period(F.col("last_period"), F.col("index") + 1).alias("period"),
            half_even(F.col("value")).alias("ma_forecast"),
        )
    )


def future_period(last_period: Column, step: Column) -> Column:
    return period(F.add_months(period_start(last_period), step))


def future_months(latest_rows: DataFrame, horizon: int = 6) -> DataFrame:
    """The next ``horizon`` calendar months of each row of (…, last_period)."""
    start = F.add_months(period_start(F.col("last_period")), F.col("step"))
    return (
        latest_rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
        .withColumn("future_start", start)
        .withColumns(
            {
                "period": period(F.col("future_start")),
                "month": F.month("future_start"),
                "quarter": F.quarter("future_start"),
            }
        )
        .drop("future_start")
    )
