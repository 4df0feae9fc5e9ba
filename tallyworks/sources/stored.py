"""Reads of the stored ledger that touch only the months asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyworks.operators.summaries import MONTH


def read_ledger(spark: SparkSession, target: str, schema: StructType | None = None) -> DataFrame:
    """The ledger that a run stored under ``target``, partitioned by (year, month)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{target.rstrip('/')}/transactions")


def month_number(year: Column | int, month: Column | int) -> Column:
    return F.lit(12) * year + month


def between_months(ledger: DataFrame, first: tuple[int, int], last: tuple[int, int]) -> DataFrame:
    """The rows of the months (year, month) from ``first`` to ``last``.

    The condition is on partition columns alone, so no other month's files are opened.
    """
    (low_year, low_month), (high_year, high_month) = first, last
    number = month_number(F.col("year"), F.col("month"))
    return ledger.where(
        F.col("year").between(low_year, high_year)
        & number.between(12 * low_year + low_month, 12 * high_year + high_month)
    )


def of_months(ledger: DataFrame, months: DataFrame) -> DataFrame:
    """The rows of the months in ``months`` (year, month): at most one row a calendar month.

    ``months`` may come from any filter on any table, such as a quarter of the monthly summary. Its
    rows decide at run time which partitions are read.
    """
    wanted = F.broadcast(months.select(*MONTH).distinct())
    return ledger.join(wanted, MONTH).select(ledger.columns)
