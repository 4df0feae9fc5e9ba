"""From validated transactions to the enriched ledger."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.calendar import date_features
from tallyworks.functions.rounding import half_even
from tallyworks.operators.joins import lookup
from tallyworks.operators.quantile import quantile_cutoff
from tallyworks.schemas import LEDGER_COLUMNS, WIDE_MONEY

HIGH_VALUE_FRACTION = Decimal("0.9")
RETURNED = "Returned"


def gross_margin_pct(profit: Column, revenue: Column) -> Column:
    """Profit as a percentage of revenue, two places; 0 unless revenue is positive."""
    percent = profit.cast("double") / revenue.cast("double") * 100.0
    return F.when(revenue > 0, half_even(percent)).otherwise(F.lit(0.0))


def revenue_per_unit(revenue: Column, quantity: Column) -> Column:
    return half_even(revenue.cast("double") / F.nullif(quantity, F.lit(0)))


def with_date_features(transactions: DataFrame) -> DataFrame:
    return transactions.withColumns(date_features(F.col("date")))


def with_month(transactions: DataFrame) -> DataFrame:
    return transactions.withColumns({"year": F.year("date"), "month": F.month("date")})


def with_customer(
    transactions: DataFrame,
    customers: DataFrame,
    keys_from: DataFrame | None = None,
    spread_by: Sequence[str | Column] = ("transaction_id", "product_id", "revenue"),
) -> DataFrame:
    """Region, segment and city where the source does not carry them."""
    if "region" in transactions.columns:
        return transactions
    return lookup(
        transactions,
        customers.select("customer_id", "region", "segment", "city"),
        "customer_id",
        spread_by=spread_by,
        keys_from=keys_from,
    )


def with_product(
    transactions: DataFrame,
    products: DataFrame,
    keys_from: DataFrame | None = None,
    spread_by: Sequence[str | Column] = ("transaction_id", "revenue", "quantity"),
) -> DataFrame:
    """Category and cost price where the source does not carry them."""
    if "cost_price" in transactions.columns:
        return transactions
    return lookup(
        transactions,
        products.select("product_id", "category", "cost_price"),
        "product_id",
        spread_by=spread_by,
        keys_from=keys_from,
    )


def with_cost(transactions: DataFrame) -> DataFrame:
    """Cost and profit where the source does not carry them."""
    if "cost" in transactions.columns:
        return transactions
    return transactions.withColumn(
        "cost", (F.col("cost_price") * F.col("quantity")).cast(WIDE_MONEY)
    ).withColumn("profit", (F.col("revenue") - F.col("cost")).cast(WIDE_MONEY))


def with_ratios(transactions: DataFrame) -> DataFrame:
    return transactions.withColumns(
        {
            "gross_margin_pct": gross_margin_pct(F.col("profit"), F.col("revenue")),
            "revenue_per_unit": revenue_per_unit(F.col("revenue"), F.col("quantity")),
        }
    )


def with_high_value_flag(transactions: DataFrame, population: DataFrame) -> DataFrame:
    """Flag the rows at or above the 90th revenue percentile of ``population``.

    The cutoff is a scalar subquery over one column, so the joins above it are
    not repeated to find it.
    """
    cutoff = quantile_cutoff(population, "revenue", HIGH_VALUE_FRACTION).scalar()
    return transactions.withColumn(
        "is_high_value", F.coalesce(F.col("revenue") >= cutoff, F.lit(False))
    )


def enrich(
    transactions: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    population: DataFrame | None = None,
    gather: Callable[[DataFrame], DataFrame] | None = None,
    has_month: bool = False,
) -> DataFrame:
    """The 30-column ledger, one row per transaction.

    All that follows from other columns is added after the last shuffle: after the lookups, and after
    ``gather``, which may bring together the rows of a month (they have year and month by then). Rows
    that had these before (``has_month``: ``with_month`` added them) keep them, and an order by them.

    ``population`` supplies the revenues the high-value cutoff is taken from. By
    default the joined rows do; a caller that knows the dimension keys to be
    unique passes rows from before any join instead.
    """
    unjoined = transactions if population is None else population
    joined = with_product(transactions, products, keys_from=unjoined)
    joined = with_customer(joined, customers, keys_from=transactions)
    ledger = joined
    if gather is not None:
        ledger = gather(with_month(ledger))
    features = date_features(F.col("date"))
    if gather is not None or has_month:
        features = {name: value for name, value in features.items() if name not in ("year", "month")}
    ledger = with_ratios(with_cost(ledger.withColumns(features)))
    ledger = with_high_value_flag(ledger, joined if population is None else population)
    return ledger.select(LEDGER_COLUMNS)


def is_kept() -> Column:
    """Whether a row was not returned; an unknown status is kept."""
    return ~F.col("status").eqNullSafe(F.lit(RETURNED))


def not_returned(ledger: DataFrame) -> DataFrame:
    return ledger.where(is_kept())
