from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from tallyworks.functions.rounding import as_double_ratio, exact_ratio, half_even, half_up


def one(spark, **columns):
    return spark.range(1).select([c.alias(n) for n, c in columns.items()]).first()


def test_half_even_goes_to_the_even_neighbour(spark):
    row = one(
        spark,
        down=half_even(F.lit(48691963.125)),
        also_down=half_even(F.lit(49186997.925)),
        up=half_even(F.lit(48980518.275)),
        missing=half_even(F.lit(None).cast("double")),
    )
    assert tuple(row) == (48691963.12, 49186997.92, 48980518.28, None)


def test_half_up_goes_away_from_zero(spark):
    row = one(
        spark,
        positive=half_up(F.lit(Decimal("0.125"))),
        negative=half_up(F.lit(Decimal("-0.125"))),
    )
    assert tuple(row) == (Decimal("0.13"), Decimal("-0.13"))


def test_ratios_with_a_zero_denominator_are_null(spark):
    row = one(
        spark,
        a=as_double_ratio(F.lit(1), F.lit(0)),
        b=exact_ratio(F.lit(Decimal("1.00")), F.lit(0)),
        c=exact_ratio(F.lit(Decimal("1.00")), F.lit(3)),
    )
    assert row.a is None and row.b is None
    assert abs(row.c - Decimal(1) / 3) < Decimal("1e-6")
