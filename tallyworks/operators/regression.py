"""Ordinary least squares per series, its hold-out metrics and its forecast."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.functions.calendar import season_cosine, season_sine
from tallyworks.functions.rounding import half_even
from tallyworks.operators.series import future_months, whole_series

# Columns that depend on each other up to rounding count as dependent: below this share of the
# largest singular value. Centred columns of a few rows leave some 1e-15 of it.
DEPENDENT = 1e-8
FEATURES = ["t", "sin_month", "cos_month", "quarter_enc", "ma_3", "lag_1"]


def feature_array(**replaced: Column) -> Column:
    return F.array(*[replaced.get(name, F.col(name)).cast("double") for name in FEATURES])


def scaling(column: str) -> tuple[Column, Column]:
    """Mean and population deviation of the training rows; a constant scales by 1."""
    trained = F.when(F.col("is_train"), F.col(column))
    deviation = F.stddev_pop(trained).over(whole_series())
    return F.avg(trained).over(whole_series()), F.when(deviation == 0, 1.0).otherwise(deviation)


def with_scaling(split: DataFrame) -> DataFrame:
    """``mean_*`` and ``scale_*`` of every model column, on every row of the series."""
    scales = {}
    for name in FEATURES:
        scales[f"mean_{name}"], scales[f"scale_{name}"] = scaling(name)
    return split.withColumns(scales)


def feature_scaling(split: DataFrame) -> DataFrame:
    """One row per (series, feature): training mean and scale."""
    trained = split.where("is_train").select(
        "series", *[F.col(name).cast("double").alias(name) for name in FEATURES]
    )
    return (
        trained.unpivot("series", FEATURES, "feature", "value")
        .groupBy("series", "feature")
        .agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("deviation"))
        .select(
            "series",
            "feature",
            "mean",
            F.when(F.col("deviation") == 0, 1.0).otherwise(F.col("deviation")).alias("scale"),
        )
    )


def standardise(values: Column, means: Column, scales: Column) -> Column:
    centred = F.zip_with(values, means, lambda v, m: v - m)
    return F.zip_with(centred, scales, lambda v, s: v / s)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def least_squares(rows: pd.Series, targets: pd.Series) -> pd.Series:
    """Intercept and coefficients per series; null without training rows.

    ``rows`` holds each series' standardised features row after row. Series of
    equal length are solved together; too few rows give the shortest solution.
    """
    fitted = pd.Series([None] * len(targets), dtype=object)
    lengths = targets.map(len)
    for length, members in lengths.groupby(lengths).groups.items():
        if length == 0:
            continue
        x = np.stack(rows[members].to_list()).reshape(len(members), length, -1)
        y = np.stack(targets[members].to_list())
        level = y.mean(axis=1)
        inverse = np.linalg.pinv(x, rcond=DEPENDENT)
        slopes = np.einsum("skn,sn->sk", inverse, y - level[:, None])
        for member, row in zip(members, np.column_stack([level, slopes]), strict=True):
            fitted[member] = row
    return fitted


def fit(split: DataFrame) -> DataFrame:
    """One model row per series, fitted on the training rows only.

    Besides the coefficients it carries what forecasting needs: the scaling, the
    last month's values and the standardised hold-out rows. Windows and grouping
    share one exchange by series.
    """
    means = F.array(*[f"mean_{name}" for name in FEATURES])
    scales = F.array(*[f"scale_{name}" for name in FEATURES])
    z = standardise(feature_array(), means, scales)
    actual = F.col("revenue").cast("double")
    row = F.struct("t", "period", actual.alias("actual"), z.alias("z"))
    gathered = (
        with_scaling(split)
        .groupBy("series")
        .agg(
            F.array_sort(F.collect_list(F.when(F.col("is_train"), row))).alias("train"),
            F.array_sort(F.collect_list(F.when(~F.col("is_train"), row))).alias("hold_out"),
            F.first(means).alias("means"),
            F.first(scales).alias("scales"),
            F.max_by(F.struct("t", "period", "month", "ma_3", actual.alias("revenue")), "t").alias(
                "last"
            ),
        )
    )
    solution = least_squares(
        F.flatten(F.transform("train", lambda r: r["z"])),
        F.transform("train", lambda r: r["actual"]),
    )
    return gathered.select(
        "series",
        F.size("train").alias("train_rows"),
        solution.alias("coefficients"),
        "means",
        "scales",
        "hold_out",
        "last",
    )


def predict(z: Column, coefficients: Column) -> Column:
    slopes = F.slice(coefficients, F.lit(2), F.lit(len(FEATURES)))
    products = F.zip_with(z, slopes, lambda v, b: v * b)
    return F.aggregate(products, F.get(coefficients, F.lit(0)), lambda a, b: a + b)


def hold_out_predictions(models: DataFrame) -> DataFrame:
    """(series, period, actual, predicted) of the rows kept from training."""
    return models.select(
        "series", "coefficients", F.explode("hold_out").alias("row")
    ).select(
        "series",
        F.col("row.period").alias("period"),
        F.col("row.actual").alias("actual"),
        predict(F.col("row.z"), F.col("coefficients")).alias("predicted"),
    )


def hold_out_metrics(predictions: DataFrame) -> DataFrame:
    """MAE, RMSE, R2, MAPE and accuracy per series.

    R2 is null for fewer than two rows; months without revenue leave MAPE out.
    """
    error = F.col("actual") - F.col("predicted")
    share = F.abs(error / F.nullif("actual", F.lit(0.0)))
    summed = predictions.groupBy("series").agg(
        F.count("predicted").alias("test_rows"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.sum(error * error).alias("residual"),
        (F.var_pop("actual") * F.count("actual")).alias("spread"),
        (F.avg(share) * 100.0).alias("mape"),
    )
    explained = (
        F.when(F.col("test_rows") < 2, None)
        .when(F.col("spread") > 0, 1.0 - F.col("residual") / F.col("spread"))
        .when(F.col("residual") == 0, 1.0)
        .otherwise(0.0)
    )
    return summed.select(
        "series",
        "test_rows",
        "mae",
        "rmse",
        explained.alias("r2"),
        "mape",
        (100.0 - F.col("mape")).alias("accuracy"),
    )


def future_features(models: DataFrame, horizon: int = 6) -> DataFrame:
    """Model columns of the coming months; trailing mean and lag stay at the last month's."""
    coming = future_months(models.withColumn("last_period", F.col("last.period")), horizon)
    return coming.withColumns(
        {
            "t": F.col("last.t") + F.col("step"),
            "sin_month": season_sine(F.col("month")),
            "cos_month": season_cosine(F.col("month")),
            "quarter_enc": F.col("quarter"),
            "ma_3": F.col("last.ma_3"),
            "lag_1": F.col("last.revenue"),
        }
    )


def regression_forecast(models: DataFrame, horizon: int = 6) -> DataFrame:
    """(series, step, period, lr_forecast), never below zero."""
    z = standardise(feature_array(), F.col("means"), F.col("scales"))
    value = predict(z, F.col("coefficients"))
    return future_features(models, horizon).select(
        "series",
        "step",
        "period",
        F.when(value.isNotNull(), half_even(F.greatest(value, F.lit(0.0)))).alias("lr_forecast"),
    )
