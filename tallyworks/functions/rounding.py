"""The two rounding rules of the results.

Summary and forecast stages round doubles half-to-even after scaling; report
views round exact decimals half-away-from-zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.schemas import TOTAL_MONEY


def half_even(value: Column, places: int = 2) -> Column:
    scale = float(10**places)
    return F.rint(value.cast("double") * scale) / scale


def half_up(value: Column, places: int = 2) -> Column:
    return F.round(value, places)


def as_double_ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that yields null for a zero denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def exact_ratio(numerator: Column, denominator: Column) -> Column:
    """Decimal division that yields null for a zero denominator.

    The declared types leave 14 places in the quotient, so that rounding to two
    places afterwards rounds once.
    """
    divisor = denominator.cast(T.DecimalType(20, 2))
    return numerator.cast(T.DecimalType(24, 2)) / F.nullif(divisor, F.lit(0).cast(T.DecimalType(20, 2)))


def as_totals(summary: DataFrame) -> DataFrame:
    """Every decimal column as a money total, whatever types its sum went through."""
    return summary.select(
        [
            F.col(field.name).cast(TOTAL_MONEY).alias(field.name)
            if isinstance(field.dataType, T.DecimalType)
            else F.col(field.name)
            for field in summary.schema.fields
        ]
    )


def decimals_as_doubles(frame: DataFrame) -> DataFrame:
    """Output edge: decimals leave as doubles, everything else unchanged."""
    return frame.select(
        [
            F.col(field.name).cast("double").alias(field.name)
            if isinstance(field.dataType, T.DecimalType)
            else F.col(field.name)
            for field in frame.schema.fields
        ]
    )
