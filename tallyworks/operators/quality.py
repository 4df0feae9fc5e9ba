"""Validation: null counts, exact duplicates and rows that cannot be sales."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEGATIVE_REVENUE = "negative_revenue"
NON_POSITIVE_QUANTITY = "non_positive_quantity"


def fault() -> Column:
    """The first rule a row breaks; null values break none."""
    return F.when(F.col("revenue") < 0, NEGATIVE_REVENUE).when(
        F.col("quantity") <= 0, NON_POSITIVE_QUANTITY
    )


def count_copies(rows: DataFrame, together: Sequence[str] = ()) -> DataFrame:
    """One row per distinct row, with its number of ``copies``.

    Copies merge on the map side, so a heavily repeated row costs one row per task. ``together`` names
    columns that follow from the others and that the rows are partitioned by: then there is no shuffle,
    and they are dropped.
    """
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies")).drop(*together)


def judged(rows: DataFrame) -> DataFrame:
    return rows.withColumn("fault", fault())


def collapse_duplicates(transactions: DataFrame, together: Sequence[str] = ()) -> DataFrame:
    """One row per distinct row, with its number of ``copies`` and its ``fault``.

    Everything the validation reports derives from this one shuffle, or none (``count_copies``).
    """
    return judged(count_copies(transactions, together))


def drop_duplicates(transactions: DataFrame, together: Sequence[str] = ()) -> DataFrame:
    return transactions.dropDuplicates().drop(*together)


def drop_negative_revenue(transactions: DataFrame) -> DataFrame:
    return transactions.where(F.coalesce(F.col("revenue") >= 0, F.lit(True)))


def drop_non_positive_quantity(transactions: DataFrame) -> DataFrame:
    return transactions.where(F.coalesce(F.col("quantity") > 0, F.lit(True)))


def accepted(collapsed: DataFrame) -> DataFrame:
    return collapsed.where(F.col("fault").isNull()).drop("copies", "fault")


def validate(transactions: DataFrame, together: Sequence[str] = ()) -> DataFrame:
    return accepted(collapse_duplicates(transactions, together))


def audit_metrics(columns: list[str]) -> list[Column]:
    """What ``validation_counts`` and ``null_counts`` count, as aggregates of collapsed rows."""
    nulls = [
        F.coalesce(F.sum(F.when(F.col(c).isNull(), F.col("copies")).otherwise(0)), F.lit(0)).alias(f"nulls {c}")
        for c in columns
    ]
    return [*count_rules(), *nulls]


def count_rules() -> list[Column]:
    return [
        F.coalesce(F.sum("copies"), F.lit(0)).alias("loaded"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"),
        F.count_if(F.col("fault") == NEGATIVE_REVENUE).alias(NEGATIVE_REVENUE),
        F.count_if(F.col("fault") == NON_POSITIVE_QUANTITY).alias(NON_POSITIVE_QUANTITY),
        F.count_if(F.col("fault").isNull()).alias("remaining"),
    ]


def null_counts(collapsed: DataFrame) -> DataFrame:
    """(column_name, nulls) over the rows as loaded, only where above zero."""
    columns = [c for c in collapsed.columns if c not in ("copies", "fault")]
    counted = collapsed.agg(
        *[F.sum(F.when(F.col(c).isNull(), F.col("copies")).otherwise(0)).alias(c) for c in columns]
    )
    return counted.unpivot([], columns, "column_name", "nulls").where(F.col("nulls") > 0)


def validation_counts(collapsed: DataFrame) -> DataFrame:
    """One row: loaded, duplicates, rows per broken rule, removed, remaining."""
    return collapsed.agg(*count_rules()).withColumn("removed", F.col("loaded") - F.col("remaining"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each table."""
    counted = [
        frame.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, frame in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def duplicate_keys(dimension: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once and would multiply joined rows."""
    return dimension.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def unmatched_keys(rows: DataFrame, dimension: DataFrame, key: str, name: str) -> DataFrame:
    """(dimension, key, rows): keys of ``rows`` that a left join with ``dimension`` misses.

    Rows collapse to one per key before they are shuffled to the join, so a hot key is one row
    a task. A null key matches nothing and is reported as null.
    """
    used = rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return used.join(dimension.select(key), key, "left_anti").select(
        F.lit(name).alias("dimension"), F.col(key).cast("string").alias("key"), "rows"
    )
