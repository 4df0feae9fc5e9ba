"""Series made by hand and an independent fit, for the forecast tests."""

from __future__ import annotations

from decimal import Decimal

import numpy as np
from pyspark.sql import functions as F

from tallyworks.functions.calendar import period


def months(spark, named):
    """A series frame from {name: [revenue, ...]}, each from 2022-01 on."""
    rows = [
        (name, i, Decimal(str(value)))
        for name, values in named.items()
        for i, value in enumerate(values)
    ]
    start = F.add_months(F.lit("2022-01-01").cast("date"), F.col("i"))
    return spark.createDataFrame(rows, "series string, i int, revenue decimal(18,2)").select(
        "series", period(start).alias("period"), F.year(start).alias("year"),
        F.month(start).alias("month"), F.quarter(start).alias("quarter"), "revenue",
    )


def separate_fit(y):
    """Six forecasts of one series by minimum-norm least squares on scaled columns."""
    n = len(y)
    i = np.arange(n)
    month = i % 12 + 1

    def columns(t, m, trailing, lag):
        angle = 2 * np.pi * m / 12
        return np.column_stack(
            [t, np.sin(angle), np.cos(angle), (m - 1) // 3 + 1, trailing, lag]
        ).astype(float)

    trailing = np.array([y[max(0, k - 2) : k + 1].mean() for k in i])
    lag = np.concatenate([[np.nan], y[:-1]])
    x = columns(i, month, trailing, lag)[3:]
    kept = int((n - 3) * 0.8)
    mean, scale = x[:kept].mean(0), x[:kept].std(0)
    scale[scale == 0] = 1
    slopes = np.linalg.lstsq((x[:kept] - mean) / scale, y[3:][:kept] - y[3:][:kept].mean(), rcond=1e-8)[0]
    step = np.arange(1, 7)
    coming = columns(n - 1 + step, (month[-1] - 1 + step) % 12 + 1, np.full(6, trailing[-1]), np.full(6, y[-1]))
    return np.maximum((coming - mean) / scale @ slopes + y[3:][:kept].mean(), 0)
