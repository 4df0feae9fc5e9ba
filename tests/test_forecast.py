"""Forecasts of a published series, its guards and an independent fit."""

from __future__ import annotations

import numpy as np
import pytest

from tallyworks.operators import regression, series
from tallyworks.plans import forecast
from tests_helpers import months, separate_fit

# 36 months of revenue from 2022-01 and the forecasts they give.
REVENUE = """
15510899.26 17251726.97 18726063.41 20769366.16 22954889.01 24212913.14
25365258.15 24728663.64 25565470.09 26159022.59 26794072.71 28509853.20
31101566.05 25063875.98 30460260.05 30060881.57 30601413.62 30569449.47
33977946.74 33985397.58 34986130.18 38414369.56 40385456.89 41198017.82
40975098.83 40413465.43 44259612.92 44473909.06 43608774.18 43464660.70
45441551.54 45691040.21 46316918.61 50652725.50 49049310.77 44119677.72
""".split()
FORECASTS = [
    ("2025-01", 47940571.33, 50040529.61, 48990550.47),
    ("2025-02", 47036519.94, 50347406.31, 48691963.12),
    ("2025-03", 46365589.66, 50551994.30, 48458791.98),
    ("2025-04", 47114226.98, 51259768.87, 49186997.92),
    ("2025-05", 46838778.86, 51122257.69, 48980518.28),
    ("2025-06", 46772865.17, 50836601.25, 48804733.21),
]


@pytest.fixture(scope="module")
def published(spark):
    return months(spark, {"total": REVENUE})


def test_published_forecast(published):
    detail = forecast.forecast_detail(published).collect()
    assert [(r.period, r.ma_3_forecast, r.lr_forecast, r.ensemble_forecast) for r in detail] == FORECASTS
    assert {r.type for r in detail} == {"Forecast"}


def test_published_metrics(published):
    row = forecast.run_summary(forecast.fit(published)).first()
    assert (row.train_rows, row.test_rows) == (26, 7)
    assert row.mae == pytest.approx(1196043.2688, abs=1e-3)
    assert row.rmse == pytest.approx(1993233.5557, abs=1e-3)
    assert row.r2 == pytest.approx(0.3107281098, abs=1e-9)
    assert row.mape == pytest.approx(2.6621593, abs=1e-6)
    assert row.accuracy == pytest.approx(100 - row.mape)


def test_actuals_come_before_the_forecast(published):
    rows = forecast.actuals_and_forecast(published, forecast.forecast_detail(published)).collect()
    assert [r.type for r in rows] == ["Actual"] * 36 + ["Forecast"] * 6
    assert rows[0].revenue == 15510899.26 and rows[36].revenue == 48990550.47


def test_features_of_the_first_months(published):
    first = series.with_features(published).orderBy("t").limit(4).collect()
    assert [r.t for r in first] == [0, 1, 2, 3]
    assert first[0].ma_3 == 15510899.26 and first[0].lag_1 is None
    assert first[1].ma_3 == pytest.approx((15510899.26 + 17251726.97) / 2)
    assert first[3].lag_3 == 15510899.26 and first[3].lag_1 == 18726063.41
    assert first[2].sin_month == pytest.approx(1.0) and first[2].quarter_enc == 1


def ramp(count, slope=1000.0):
    return [round(50_000 + slope * i + 37 * (i % 5), 2) for i in range(count)]


def test_strong_fit_weighs_the_regression_more(spark):
    steady = months(spark, {"steady": ramp(40)})
    assert forecast.run_summary(forecast.fit(steady)).first().r2 > 0.8
    for row in forecast.forecast_detail(steady).collect():
        assert row.ensemble_forecast == pytest.approx(
            0.65 * row.lr_forecast + 0.35 * row.ma_3_forecast, abs=0.0051
        )


def test_short_series(spark):
    frame = months(spark, {f"n{n}": ramp(n) for n in (1, 2, 3, 4, 5, 8)})
    detail = {}
    for row in forecast.forecast_detail(frame).collect():
        detail.setdefault(row.series, []).append(row)
    assert {name: len(rows) for name, rows in detail.items()} == dict.fromkeys(detail, 6)
    for name in ("n1", "n2", "n3", "n4"):
        assert all(r.lr_forecast is None for r in detail[name])
        assert all(r.ensemble_forecast == r.ma_3_forecast for r in detail[name])
    assert all(r.lr_forecast is not None for r in detail["n5"] + detail["n8"])
    assert detail["n1"][0].ma_3_forecast == 50_000.0
    assert detail["n2"][0].ma_3_forecast == pytest.approx(50_518.5)
    summary = {r.series: r for r in forecast.run_summary(forecast.fit(frame)).collect()}
    # one row to test on leaves R2 undefined
    assert summary["n8"].r2 is None and summary["n8"].mae is not None


def test_falling_series_is_clamped_at_zero(spark):
    falling = months(spark, {"down": [max(100_000.0 - 4_000 * i, 1.0) for i in range(25)]})
    values = [r.lr_forecast for r in forecast.forecast_detail(falling).collect()]
    assert all(v >= 0 for v in values) and 0.0 in values


def test_months_without_revenue_leave_mape_defined(spark):
    values = ramp(36)
    values[34] = 0.0
    row = forecast.run_summary(forecast.fit(months(spark, {"gap": values}))).first()
    assert row.mape is not None and np.isfinite(row.mape)


def test_many_series_equal_a_separate_fit_each(spark):
    rng = np.random.default_rng(3)
    named = {
        f"s{k}": np.round(10_000 + 300 * np.arange(n) + rng.normal(0, 900, n), 2).tolist()
        for k, n in enumerate([36, 36, 24, 40, 17, 9])
    }
    found = {}
    for row in regression.regression_forecast(
        forecast.fit(months(spark, named)).repartition(3)
    ).collect():
        found.setdefault(row.series, {})[row.step] = row.lr_forecast
    for name, values in named.items():
        assert [found[name][s] for s in range(1, 7)] == pytest.approx(
            separate_fit(np.array(values)), abs=0.02
        )
