"""Monthly summary tables over the enriched ledger's non-returned rows.

Rows whose group key is null are left out. Results carry exact decimals;
only means and percentages are doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.calendar import month_start, period
from tallyworks.functions.rounding import as_double_ratio, as_totals, half_even
from tallyworks.operators.enrich import not_returned

MONTH = ["year", "month"]


def known_rows(ledger: DataFrame, keys: list[str]) -> DataFrame:
    return not_returned(ledger).dropna(subset=keys)


def mean_margin(margin: Column) -> Column:
    """Mean of two-place margins, two places, summed exactly as hundredths."""
    hundredths = F.rint(margin * 100.0).cast("long")
    return F.rint(as_double_ratio(F.sum(hundredths), F.count(margin))) / 100.0


def mean(value: Column) -> Column:
    return half_even(as_double_ratio(F.sum(value), F.count(value)))


def with_period(summary: DataFrame) -> DataFrame:
    """The key that relates a summary to the monthly figures and the forecast."""
    return summary.withColumn("period", period(month_start(F.col("year"), F.col("month"))))


def customers_per(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Distinct customers per group; a group of unknown customers counts zero.

    Counting them apart keeps the other totals out of the shuffle by customer:
    that one moves bare keys, while the totals shrink to one row per group and task.
    """
    pairs = rows.select(*keys, "customer_id").distinct()
    return pairs.groupBy(*keys).agg(F.count("customer_id").alias(name))


def monthly_totals(rows: DataFrame, *more: Column) -> DataFrame:
    return rows.groupBy(*MONTH).agg(
        F.sum("revenue").alias("total_revenue"),
        F.sum("profit").alias("total_profit"),
        F.sum("cost").alias("total_cost"),
        F.count("transaction_id").alias("total_orders"),
        F.sum("quantity").alias("total_units"),
        mean(F.col("revenue")).alias("avg_order_value"),
        mean_margin(F.col("gross_margin_pct")).alias("avg_margin_pct"),
        F.count_if("is_high_value").alias("high_value_orders"),
        F.count_if("is_returned").alias("returns"),
        *more,
    )


def labelled_months(totals: DataFrame) -> DataFrame:
    # month_name, quarter and period follow from (year, month): two integers shuffle
    start = month_start(F.col("year"), F.col("month"))
    return as_totals(totals).select(
        "year",
        "month",
        F.monthname(start).alias("month_name"),
        F.quarter(start).alias("quarter"),
        "total_revenue",
        "total_profit",
        "total_cost",
        "total_orders",
        "total_units",
        "avg_order_value",
        "avg_margin_pct",
        "unique_customers",
        "high_value_orders",
        "returns",
        half_even(as_double_ratio(F.col("returns"), F.col("total_orders")) * 100.0).alias(
            "return_rate_pct"
        ),
        period(start).alias("period"),
    ).orderBy("period")


def monthly_summary(ledger: DataFrame) -> DataFrame:
    rows = known_rows(ledger, MONTH)
    customers = customers_per(rows, MONTH, "unique_customers")
    return labelled_months(monthly_totals(rows).join(customers, MONTH))


def monthly_return_rates(ledger: DataFrame) -> DataFrame:
    """(year, month, all_orders, returned_orders, return_rate_all_pct, period) over all rows.

    In the summaries returned rows leave first, so their return rate is zero by construction.
    """
    counted = ledger.dropna(subset=MONTH).groupBy(*MONTH).agg(
        F.count("transaction_id").alias("all_orders"),
        F.count_if("is_returned").alias("returned_orders"),
    )
    rate = as_double_ratio(F.col("returned_orders"), F.col("all_orders")) * 100.0
    return with_period(counted.withColumn("return_rate_all_pct", half_even(rate))).orderBy("period")


def category_summary(ledger: DataFrame) -> DataFrame:
    keys = [*MONTH, "category"]
    totals = (
        known_rows(ledger, keys)
        .groupBy(*keys)
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum("profit").alias("profit"),
            F.count("transaction_id").alias("orders"),
            F.sum("quantity").alias("units"),
        )
    )
    return as_totals(totals).orderBy(*keys)


def region_summary(ledger: DataFrame) -> DataFrame:
    keys = [*MONTH, "region", "segment"]
    rows = known_rows(ledger, keys)
    totals = rows.groupBy(*keys).agg(
        F.sum("revenue").alias("revenue"),
        F.sum("profit").alias("profit"),
        F.count("transaction_id").alias("orders"),
    )
    return as_totals(totals).join(customers_per(rows, keys, "customers"), keys).orderBy(*keys)


def channel_summary(ledger: DataFrame) -> DataFrame:
    keys = [*MONTH, "channel", "campaign"]
    totals = (
        known_rows(ledger, keys)
        .groupBy(*keys)
        .agg(
            F.sum("revenue").alias("revenue"),
            F.count("transaction_id").alias("orders"),
            mean(F.col("discount_pct")).alias("avg_discount"),
            F.sum("discount_amount").alias("total_discount"),
        )
    )
    return as_totals(totals).orderBy(*keys)


def with_margin(totals: DataFrame) -> DataFrame:
    return totals.withColumn(
        "gross_margin_pct",
        half_even(as_double_ratio(F.col("total_profit"), F.col("total_revenue")) * 100.0),
    )


def kpi_totals(ledger: DataFrame) -> DataFrame:
    """One row: total revenue and profit, average order value, gross margin %."""
    totals = not_returned(ledger).agg(
        F.sum("revenue").alias("total_revenue"),
        F.sum("profit").alias("total_profit"),
        mean(F.col("revenue")).alias("avg_order_value"),
    )
    return with_margin(as_totals(totals))
