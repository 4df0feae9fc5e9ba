"""Calendar columns derived from a date or from (year, month)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_features(date: Column) -> dict[str, Column]:
    """The seven calendar columns of the ledger, in order."""
    return {
        "year": F.year(date),
        "month": F.month(date),
        "month_name": F.monthname(date),
        "quarter": F.quarter(date),
        "week": F.weekofyear(date),
        "day_name": F.date_format(date, "EEEE"),
        # weekday() counts from Monday = 0
        "is_weekend": F.weekday(date) >= 5,
    }


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def period(date: Column) -> Column:
    """``YYYY-MM`` label."""
    return F.date_format(date, "yyyy-MM")


def period_start(label: Column) -> Column:
    return F.to_date(label, "yyyy-MM")


def season_sine(month: Column) -> Column:
    return F.sin(F.lit(2.0) * F.pi() * month / F.lit(12.0))


def season_cosine(month: Column) -> Column:
    return F.cos(F.lit(2.0) * F.pi() * month / F.lit(12.0))
