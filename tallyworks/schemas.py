"""Declared schemas; no reader infers types."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
WIDE_MONEY = T.DecimalType(14, 2)
# Sums of money in summaries and reports, however they were added up.
TOTAL_MONEY = T.DecimalType(22, 2)

TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("campaign", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", MONEY),
        T.StructField("discount_pct", T.IntegerType()),
        T.StructField("discount_amount", MONEY),
        T.StructField("revenue", MONEY),
        T.StructField("cost", WIDE_MONEY),
        T.StructField("profit", WIDE_MONEY),
        T.StructField("is_returned", T.BooleanType()),
        T.StructField("status", T.StringType()),
    ]
)

CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("segment", T.StringType()),
        T.StructField("join_date", T.DateType()),
        T.StructField("email", T.StringType()),
    ]
)

PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("unit_price", MONEY),
        T.StructField("cost_price", MONEY),
        T.StructField("return_rate", T.DoubleType()),
    ]
)

# Column order of the enriched ledger: 15 as loaded, 15 added.
LEDGER_COLUMNS = TRANSACTIONS.fieldNames() + [
    "year",
    "month",
    "month_name",
    "quarter",
    "week",
    "day_name",
    "is_weekend",
    "region",
    "segment",
    "city",
    "category",
    "cost_price",
    "gross_margin_pct",
    "revenue_per_unit",
    "is_high_value",
]
