"""Report views over the summaries and the ledger, and the dashboard queries.

Money and ratios round half-away-from-zero on exact decimals.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.functions.rounding import exact_ratio, half_up
from tallyworks.operators.enrich import RETURNED
from tallyworks.operators.summaries import with_period

def _percent(part: Column, whole: Column) -> Column:
    return half_up(exact_ratio(part * F.lit(100), whole))


def _exact(value: Column) -> Column:
    """A two-place double as the decimal it stands for."""
    return half_up(value.cast("decimal(18,4)"))


def monthly_kpis(monthly: DataFrame) -> DataFrame:
    # one row per calendar month, so the ordered window stays small
    before = F.lag("total_revenue", 1).over(Window.orderBy("period"))
    return (
        monthly.withColumn("previous", before)
        .select(
            "year",
            "month",
            "month_name",
            "quarter",
            "period",
            half_up(F.col("total_revenue")).alias("total_revenue"),
            half_up(F.col("total_profit")).alias("total_profit"),
            half_up(F.col("total_cost")).alias("total_cost"),
            "total_orders",
            "total_units",
            _exact(F.col("avg_order_value")).alias("avg_order_value"),
            _exact(F.col("avg_margin_pct")).alias("gross_margin_pct"),
            "unique_customers",
            "high_value_orders",
            _exact(F.col("return_rate_pct")).alias("return_rate_pct"),
            _percent(F.col("total_revenue") - F.col("previous"), F.col("previous")).alias(
                "mom_revenue_growth_pct"
            ),
        )
        .orderBy("period")
    )


def sold(ledger: DataFrame) -> DataFrame:
    """The views' own filter: a row of unknown status does not count as sold."""
    return ledger.where(F.col("status") != RETURNED)


def _by_month_and_revenue(frame: DataFrame) -> DataFrame:
    return frame.orderBy("year", "month", F.desc_nulls_first("revenue"))


def category_performance(category: DataFrame) -> DataFrame:
    return _by_month_and_revenue(
        category.select(
            "year",
            "month",
            "category",
            half_up(F.col("revenue")).alias("revenue"),
            half_up(F.col("profit")).alias("profit"),
            "orders",
            "units",
            _percent(F.col("profit"), F.col("revenue")).alias("margin_pct"),
        )
    )


def regional_heatmap(region: DataFrame) -> DataFrame:
    return _by_month_and_revenue(
        region.select(
            "year",
            "month",
            "region",
            "segment",
            half_up(F.col("revenue")).alias("revenue"),
            half_up(F.col("profit")).alias("profit"),
            "orders",
            "customers",
            half_up(exact_ratio(F.col("revenue"), F.col("customers"))).alias(
                "revenue_per_customer"
            ),
        )
    )


def channel_campaign(channel: DataFrame) -> DataFrame:
    return _by_month_and_revenue(
        channel.select(
            "year",
            "month",
            "channel",
            "campaign",
            half_up(F.col("revenue")).alias("revenue"),
            "orders",
            _exact(F.col("avg_discount")).alias("avg_discount_pct"),
            half_up(F.col("total_discount")).alias("total_discount_given"),
            half_up(exact_ratio(F.col("revenue"), F.col("orders"))).alias("revenue_per_order"),
        )
    )


def top_products(ledger: DataFrame) -> DataFrame:
    """Totals per product and category; rows without a category stay."""
    hundredths = F.rint(F.col("gross_margin_pct") * 100.0).cast("long")
    return (
        sold(ledger)
        .groupBy("product_id", "category")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("quantity").alias("total_units_sold"),
            F.sum("revenue").alias("total_revenue"),
            F.sum("profit").alias("total_profit"),
            F.sum(hundredths).alias("margin_hundredths"),
            F.count("gross_margin_pct").alias("margin_rows"),
            F.count_if("is_returned").alias("total_returns"),
        )
        .select(
            "product_id",
            "category",
            "total_orders",
            "total_units_sold",
            half_up(F.col("total_revenue")).alias("total_revenue"),
            half_up(F.col("total_profit")).alias("total_profit"),
            half_up(
                exact_ratio(
                    F.col("margin_hundredths").cast("decimal(20,0)"),
                    F.col("margin_rows") * F.lit(100),
                )
            ).alias("avg_margin_pct"),
            "total_returns",
        )
        .orderBy(F.desc_nulls_first("total_revenue"), "product_id")
    )


def recency_frequency_monetary(purchases: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Per-customer totals from grouped ``purchases``; recency counts to ``as_of``."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    return purchases.select(
        "customer_id",
        "region",
        "segment",
        "frequency",
        half_up(F.col("spent")).alias("monetary"),
        half_up(exact_ratio(F.col("spent"), F.col("priced"))).alias("avg_order_value"),
        "last_purchase_date",
        F.date_diff(today, "last_purchase_date").alias("recency_days"),
    ).orderBy(F.desc_nulls_first("monetary"), "customer_id")


def purchase_totals() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("frequency"),
        F.sum("revenue").alias("spent"),
        F.count("revenue").alias("priced"),
        F.max("date").alias("last_purchase_date"),
    ]


def customer_rfm(ledger: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    purchases = (
        sold(ledger).groupBy("customer_id", "region", "segment").agg(*purchase_totals())
    )
    return recency_frequency_monetary(purchases, as_of)


def best_products(products: DataFrame, count: int = 10) -> DataFrame:
    """The ``count`` best-selling products with their margin."""
    return products.orderBy(F.desc_nulls_last("total_revenue"), "product_id").limit(count)


def category_drill_through(category: DataFrame) -> DataFrame:
    """Revenue per category and month, with a subtotal row per category."""
    return (
        category.rollup("category", "year", "month")
        .agg(F.sum("revenue").alias("revenue"), F.grouping_id().alias("level"))
        # level 0: one month; level 3: the whole category
        .where(F.col("level").isin(0, 3))
        .select("category", "year", "month", "revenue")
        .orderBy("category", F.asc_nulls_first("year"), F.asc_nulls_first("month"))
    )


def category_within_month(category: DataFrame, monthly: DataFrame) -> DataFrame:
    """Category revenue beside the month's total, related by period."""
    totals = monthly.select("period", "total_revenue")
    return (
        with_period(category)
        .join(totals, "period")
        .select(
            "period",
            "category",
            "revenue",
            "total_revenue",
            _percent(F.col("revenue"), F.col("total_revenue")).alias("revenue_share_pct"),
        )
        .orderBy("period", "category")
    )


def region_segment_matrix(region: DataFrame) -> DataFrame:
    """One row per region, one revenue column for every segment that occurs.

    Spark lists the segments of the summary first, and refuses more than
    ``spark.sql.pivotMaxValues``; a summary that is not stored is computed for that too.
    """
    return region.groupBy("region").pivot("segment").agg(F.sum("revenue")).orderBy("region")


def channel_stack(channel: DataFrame) -> DataFrame:
    """Revenue per channel, stacked by campaign."""
    return (
        channel.groupBy("channel", "campaign")
        .agg(F.sum("revenue").alias("revenue"))
        .orderBy("channel", "campaign")
    )
