"""Summaries that aggregate before they join.

For use on transactions that have not been enriched. Grouping by the lookup key
first leaves one row per key and month to join, whatever share of the rows a key
holds. Where a key repeats in a dimension that a summary does not join, the left
joins of the whole ledger would repeat rows: pass them through ``with_repeats`` first.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.rounding import as_double_ratio, as_totals, half_even
from tallyworks.operators import quality, reports, summaries
from tallyworks.operators.enrich import (
    not_returned,
    with_cost,
    with_high_value_flag,
    with_month,
    with_product,
    with_ratios,
)
from tallyworks.operators.joins import lookup, lookup_grouped
from tallyworks.operators.series import keyed_series
from tallyworks.session import settle

MONTH = summaries.MONTH


def with_repeats(transactions: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Each row as often as a left join with ``dimension`` would return it.

    Only the keys that repeat are joined; if there is none, the rows pass as they are.
    """
    repeated = quality.duplicate_keys(dimension.where(F.col(key).isNotNull()), key)
    if repeated.isEmpty():
        return transactions
    times = F.array_repeat(F.lit(1), F.coalesce(F.col("copies"), F.lit(1)).cast("int"))
    return (
        lookup(transactions, settle(repeated, "repeated"), key, ["transaction_id"])
        .withColumn("copies", F.explode(times))
        .drop("copies")
    )


def costed(
    transactions: DataFrame, products: DataFrame, unjoined: DataFrame | None = None
) -> DataFrame:
    """Non-returned rows with category, cost and row margin; margins need each row."""
    rows = with_product(not_returned(transactions), products, keys_from=unjoined)
    return with_ratios(with_cost(rows))


def monthly_summary(
    transactions: DataFrame,
    products: DataFrame,
    unjoined: DataFrame | None = None,
    population: DataFrame | None = None,
) -> DataFrame:
    """``unjoined`` has the same sales from before any join: cheaper to take statistics of.

    ``population`` supplies the revenues of the cutoff where they are not simply those.
    """
    # returned rows leave before the joins, yet count towards the high-value cutoff
    everything = transactions if unjoined is None else unjoined
    everything = everything if population is None else population
    rows = with_high_value_flag(costed(transactions, products, unjoined), everything)
    known = summaries.known_rows(with_month(rows), MONTH)
    # one pass: counting customers apart would repeat the joins
    customers = F.count_distinct("customer_id").alias("unique_customers")
    return summaries.labelled_months(summaries.monthly_totals(known, customers))


def category_summary(transactions: DataFrame, products: DataFrame) -> DataFrame:
    """Cost is price x units, so it follows from per-product unit totals."""
    revenue, quantity = F.col("revenue"), F.col("quantity")
    per_product = (
        with_month(not_returned(transactions))
        .dropna(subset=MONTH)
        .groupBy(*MONTH, "product_id")
        .agg(
            F.sum("revenue").alias("revenue"),
            F.count("transaction_id").alias("orders"),
            F.sum("quantity").alias("units"),
            # a row lacking either value has no profit
            F.sum(F.when(quantity.isNotNull(), revenue)).alias("costed_revenue"),
            F.sum(F.when(revenue.isNotNull(), quantity)).alias("costed_units"),
        )
    )
    prices = products.select("product_id", "category", "cost_price")
    priced = lookup_grouped(per_product, prices, "product_id").withColumn(
        "profit", F.col("costed_revenue") - F.col("cost_price") * F.col("costed_units")
    )
    keys = [*MONTH, "category"]
    totals = (
        priced.dropna(subset=["category"])
        .groupBy(*keys)
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum("profit").alias("profit"),
            F.sum("orders").alias("orders"),
            F.sum("units").alias("units"),
        )
    )
    return as_totals(totals).orderBy(*keys)


def region_summary(
    transactions: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    unjoined: DataFrame | None = None,
) -> DataFrame:
    """Each customer is one row per month before the join."""
    rows = with_cost(with_product(not_returned(transactions), products, keys_from=unjoined))
    per_customer = (
        with_month(rows)
        .dropna(subset=MONTH)
        .groupBy(*MONTH, "customer_id")
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum("profit").alias("profit"),
            F.count("transaction_id").alias("orders"),
        )
    )
    keys = [*MONTH, "region", "segment"]
    places = customers.select("customer_id", "region", "segment")
    placed = lookup_grouped(per_customer, places, "customer_id")
    totals = (
        placed.dropna(subset=["region", "segment"])
        .groupBy(*keys)
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum("profit").alias("profit"),
            F.sum("orders").alias("orders"),
            # a repeated customer may have several places, or the same one again
            F.count_distinct("customer_id").alias("customers"),
        )
    )
    return as_totals(totals).orderBy(*keys)


def monthly_revenue(transactions: DataFrame, *keys: str) -> DataFrame:
    """The revenue series of ``keys`` (columns of the transactions), no lookup needed."""
    return keyed_series(with_month(not_returned(transactions)), *keys)


def channel_summary(transactions: DataFrame) -> DataFrame:
    return summaries.channel_summary(with_month(transactions))


def kpi_totals(sales: DataFrame, products: DataFrame) -> DataFrame:
    """One row; the sales shrink to one row a product before they meet the prices.

    Needs no order or customer columns: pass the sales from before any join.
    """
    revenue, quantity = F.col("revenue"), F.col("quantity")
    per_product = (
        not_returned(sales)
        .groupBy("product_id")
        .agg(
            F.sum("revenue").alias("revenue"),
            F.count("revenue").alias("priced_rows"),
            # a row lacking either value has no profit
            F.sum(F.when(quantity.isNotNull(), revenue)).alias("costed_revenue"),
            F.sum(F.when(revenue.isNotNull(), quantity)).alias("costed_units"),
        )
    )
    prices = products.select("product_id", "cost_price")
    profit = F.col("costed_revenue") - F.col("cost_price") * F.col("costed_units")
    totals = (
        lookup_grouped(per_product, prices, "product_id")
        .withColumn("profit", profit)
        .agg(
            F.sum("revenue").alias("total_revenue"),
            F.sum("profit").alias("total_profit"),
            F.sum("priced_rows").alias("priced_rows"),
        )
    )
    return summaries.with_margin(
        as_totals(totals).select(
            "total_revenue",
            "total_profit",
            half_even(as_double_ratio(F.col("total_revenue"), F.col("priced_rows"))).alias(
                "avg_order_value"
            ),
        )
    )


def top_products(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Needs no order or customer columns: pass the sales from before any join."""
    return reports.top_products(costed(sales, products))


def customer_rfm(
    transactions: DataFrame, customers: DataFrame, as_of: dt.date | None = None
) -> DataFrame:
    purchases = (
        reports.sold(transactions).groupBy("customer_id").agg(*reports.purchase_totals())
    )
    places = customers.select("customer_id", "region", "segment")
    placed = lookup_grouped(purchases, places, "customer_id")
    # several rows of one customer at one place are one group of the ledger
    merged = placed.groupBy("customer_id", "region", "segment").agg(
        F.sum("frequency").alias("frequency"),
        F.sum("spent").alias("spent"),
        F.sum("priced").alias("priced"),
        F.max("last_purchase_date").alias("last_purchase_date"),
    )
    return reports.recency_frequency_monetary(merged, as_of)
