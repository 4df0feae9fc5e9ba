from __future__ import annotations

import random
from decimal import Decimal

import numpy as np
import pytest

from tallyworks.operators import quantile

CASES = {
    "spread": [round(random.Random(1).uniform(0, 90_000), 2) for _ in range(3_000)],
    "wide": [round(random.Random(2).lognormvariate(5, 4), 2) for _ in range(2_001)],
    "one value holds most rows": [500.0] * 900 + [float(i) for i in range(1_000)],
    "quantile falls on a tie": [1.0] * 5 + [2.0] * 6,
    "negative": [-10.5, -3.25, 0.0, 4.0, 100_000.0],
    "single": [7.25],
    "two far apart": [0.01, 9_999_999_999.99],
    "nulls": [1.0, None, 2.0, None, 3.0, 4.0],
}


def frame(spark, values):
    rows = [(None if v is None else Decimal(f"{v:.2f}"),) for v in values]
    return spark.createDataFrame(rows, "revenue decimal(12,2)")


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("fraction", ["0.9", "0.5", "0", "1"])
def test_equals_linear_interpolation(spark, name, fraction):
    known = np.array([v for v in CASES[name] if v is not None])
    rows = frame(spark, CASES[name])
    found = quantile.quantile(rows, "revenue", Decimal(fraction)).first().threshold
    assert found == pytest.approx(np.quantile(known, float(fraction)), rel=1e-12, abs=1e-9)


@pytest.mark.parametrize("name", CASES)
def test_cutoff_flags_the_same_rows_as_the_quantile(spark, name):
    known = np.array([v for v in CASES[name] if v is not None])
    cutoff = quantile.quantile_cutoff(frame(spark, CASES[name]), "revenue", Decimal("0.9"))
    expected = known >= np.quantile(known, 0.9)
    assert list(known >= float(cutoff.first().cutoff)) == list(expected)


def test_no_values_give_no_threshold(spark):
    rows = frame(spark, [None, None])
    assert quantile.quantile(rows, "revenue", Decimal("0.9")).first().threshold is None


def test_both_passes_share_one_shuffle_of_the_values(spark):
    # the plan that ran, once adaptive execution has settled it
    rows = spark.range(20_000).selectExpr("cast(id * 7 % 5000 as decimal(12,2)) AS revenue")
    found = quantile.quantile(rows, "revenue", Decimal("0.9"))
    found.collect()
    assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()


def test_other_types_are_refused(spark):
    for kind in ("double", "decimal(12,4)", "decimal(20,2)", "long"):
        wide = frame(spark, [1.0]).selectExpr(f"CAST(revenue AS {kind}) AS revenue")
        with pytest.raises(TypeError, match="decimal"):
            quantile.quantile(wide, "revenue", Decimal("0.9"))
    narrow = frame(spark, [1.0, 3.0]).selectExpr("CAST(revenue AS decimal(6,1)) AS revenue")
    assert quantile.quantile(narrow, "revenue", Decimal("0.5")).first().threshold == 2.0
