"""Enrichment and the summaries built from the enriched ledger."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyworks import schemas
from tallyworks.functions.calendar import date_features
from tallyworks.operators import enrich, quality, reports, summaries
from tallyworks.plans import early
from tallyworks.sources import star


def sale(number, date="2024-03-04", customer="C1", product="P1", quantity=2, revenue="100.00",
         cost="60.00", status="Completed", campaign="Summer"):
    money = None if revenue is None else Decimal(revenue)
    spent = Decimal(cost)
    return (
        f"T{number}", date and dt.date.fromisoformat(date), customer, product, "Online", campaign,
        quantity, Decimal("50.00"), 0, Decimal("0.00"), money, spent,
        None if money is None else money - spent, status == "Returned", status,
    )


@pytest.fixture(scope="module")
def dimensions(spark):
    customers = spark.createDataFrame(
        [("C1", "Ann", "Pune", "West", "Retail", None, None),
         ("C2", "Bob", "Delhi", "North", "SME", None, None)],
        schemas.CUSTOMERS,
    )
    products = spark.createDataFrame(
        [("P1", "Pen", "Books", Decimal("50.00"), Decimal("30.00"), 0.2)], schemas.PRODUCTS
    )
    return customers, products


def ledger_of(spark, dimensions, *sales):
    rows = spark.createDataFrame(list(sales), schemas.TRANSACTIONS)
    return enrich.enrich(rows, *dimensions)


def test_calendar_of_known_days(spark):
    days = ["2024-12-30", "2022-01-01", "2024-02-29"]
    rows = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "date date")
    found = [tuple(r) for r in rows.select(*date_features(F.col("date")).values()).collect()]
    assert found == [
        (2024, 12, "Dec", 4, 1, "Monday", False),
        (2022, 1, "Jan", 1, 52, "Saturday", True),
        (2024, 2, "Feb", 1, 9, "Thursday", False),
    ]


def test_ledger_has_thirty_columns_and_keeps_unmatched_rows(spark, dimensions):
    ledger = ledger_of(spark, dimensions, sale(1), sale(2, customer="C9", product=None))
    assert ledger.columns == schemas.LEDGER_COLUMNS and len(ledger.columns) == 30
    matched, unmatched = ledger.orderBy("transaction_id").collect()
    assert (matched.region, matched.category) == ("West", "Books")
    assert (unmatched.region, unmatched.category, unmatched.cost_price) == (None, None, None)


def test_ratios_at_zero_and_missing_values(spark, dimensions):
    rows = ledger_of(
        spark, dimensions, sale(1), sale(2, revenue="0.00"), sale(3, quantity=0),
        sale(4, revenue=None), sale(5, revenue="80.00", cost="100.00"),
    ).orderBy("transaction_id").collect()
    assert [r.gross_margin_pct for r in rows] == [40.0, 0.0, 40.0, 0.0, -25.0]
    assert [r.revenue_per_unit for r in rows] == [50.0, 0.0, None, None, 40.0]


def test_high_value_counts_returned_rows_and_never_flags_nulls(spark, dimensions):
    sales = [sale(i, revenue=f"{i}.00") for i in range(1, 10)]
    sales += [sale(10, revenue="1000.00", status="Returned"), sale(11, revenue=None)]
    flags = {r.transaction_id: r.is_high_value for r in ledger_of(spark, dimensions, *sales).collect()}
    # quantile of 1..9 and 1000 at 0.9 lies above 9
    assert [k for k, v in flags.items() if v] == ["T10"] and flags["T11"] is False


def test_repeated_dimension_keys_multiply_rows(spark, dimensions):
    customers, products = dimensions
    rows = spark.createDataFrame([sale(1), sale(2, customer="C2")], schemas.TRANSACTIONS)
    twice = customers.unionByName(customers.where("customer_id = 'C1'"))
    assert enrich.enrich(rows, twice, products).count() == 3


def test_cost_follows_from_the_product_where_absent(spark, dimensions):
    rows = spark.createDataFrame([sale(1, quantity=3)], schemas.TRANSACTIONS).drop("cost", "profit")
    found = enrich.enrich(rows, *dimensions).first()
    assert (found.cost, found.profit) == (Decimal("90.00"), Decimal("10.00"))


def test_summaries_leave_out_returned_rows_and_null_keys(spark, dimensions):
    ledger = ledger_of(
        spark, dimensions, sale(1), sale(2, campaign=None), sale(3, customer="C9"),
        sale(4, product="P9"), sale(5, status="Returned"), sale(6, date=None), sale(7, status=None),
    ).cache()
    month = summaries.monthly_summary(ledger).first()
    assert (month.total_orders, month.unique_customers, month.returns) == (5, 2, 0)
    assert (month.period, month.month_name, month.quarter) == ("2024-03", "Mar", 1)
    assert month.return_rate_pct == 0.0
    assert [r.orders for r in summaries.category_summary(ledger).collect()] == [4]
    assert [r.orders for r in summaries.region_summary(ledger).collect()] == [4]
    assert [r.orders for r in summaries.channel_summary(ledger).collect()] == [4]


def test_products_without_a_category_stay_in_the_product_report(spark, dimensions):
    found = reports.top_products(ledger_of(spark, dimensions, sale(1), sale(2, product="P9")))
    assert {(r.product_id, r.category) for r in found.collect()} == {("P1", "Books"), ("P9", None)}


def test_growth_rounds_half_up_and_skips_empty_months(spark):
    months = [("2024-01", "200.00"), ("2024-02", "200.25"), ("2024-03", "0.00"), ("2024-04", "5.00")]
    rows = spark.createDataFrame([(p, Decimal(v)) for p, v in months], "period string, total_revenue decimal(22,2)")
    filled = rows.selectExpr(
        "2024 year", "1 month", "'Jan' month_name", "1 quarter", "*", "total_revenue total_profit",
        "total_revenue total_cost", "1 total_orders", "1 total_units", "1.5D avg_order_value",
        "2.5D avg_margin_pct", "1 unique_customers", "0 high_value_orders", "0D return_rate_pct",
    )
    growth = [r.mom_revenue_growth_pct for r in reports.monthly_kpis(filled).collect()]
    # 0.125 % rounds away from zero
    assert growth == [None, Decimal("0.13"), Decimal("-100.00"), None]


def test_recency_counts_days_to_the_given_date(spark, dimensions):
    ledger = ledger_of(spark, dimensions, sale(1), sale(2, date="2024-03-10", revenue="50.01"))
    found = reports.customer_rfm(ledger, dt.date(2024, 4, 1)).first()
    assert (found.frequency, found.recency_days) == (2, 22)
    assert (found.monetary, found.avg_order_value) == (Decimal("150.01"), Decimal("75.01"))


def test_category_drill_through_adds_one_total_per_category(spark, dimensions):
    ledger = ledger_of(spark, dimensions, sale(1), sale(2, date="2024-05-01"))
    rows = [tuple(r) for r in reports.category_drill_through(summaries.category_summary(ledger)).collect()]
    assert rows == [
        ("Books", None, None, Decimal("200.00")),
        ("Books", 2024, 3, Decimal("100.00")),
        ("Books", 2024, 5, Decimal("100.00")),
    ]


@pytest.fixture(scope="module")
def star_tables(spark, folder):
    tables = [f(spark, folder) for f in (star.transactions, star.customers, star.products)]
    # rows without a campaign, product, customer, date, quantity or revenue as well
    rows = tables[0]
    order = F.split("transaction_id", "-")[0].cast("long")
    for n, column in enumerate(["product_id", "customer_id", "date", "quantity", "revenue", "status"]):
        rows = rows.withColumn(column, F.when(order % 23 != n, F.col(column)))
    return rows.cache(), tables[1], tables[2]


@pytest.mark.parametrize(
    ("late", "soon"),
    [
        (summaries.monthly_summary, lambda t, c, p: early.monthly_summary(t, p)),
        (summaries.category_summary, lambda t, c, p: early.category_summary(t, p)),
        (summaries.region_summary, early.region_summary),
        (summaries.channel_summary, lambda t, c, p: early.channel_summary(t)),
        (summaries.kpi_totals, lambda t, c, p: early.kpi_totals(t, p)),
        (reports.top_products, lambda t, c, p: early.top_products(t, p)),
        (reports.customer_rfm, lambda t, c, p: early.customer_rfm(t, c)),
    ],
    ids=["monthly", "category", "region", "channel", "kpi", "products", "customers"],
)
def test_early_aggregation_equals_aggregating_the_ledger(star_tables, late, soon):
    assert soon(*star_tables).collect() == late(enrich.enrich(*star_tables)).collect()


def test_category_totals_add_up_to_the_months(spark, folder):
    rows = star.transactions(spark, folder)
    products = star.products(spark, folder)
    months = early.monthly_summary(rows, products).select(
        "year", "month", "total_revenue", "total_profit", "total_cost", "total_orders", "total_units"
    )
    parts = early.category_summary(rows, products).groupBy("year", "month").agg(
        F.sum("revenue").alias("r"), F.sum("profit").alias("p"),
        F.sum("orders").alias("o"), F.sum("units").alias("u"),
    )
    for row in months.join(parts, ["year", "month"]).collect():
        assert (row.total_revenue, row.total_profit) == (row.r, row.p)
        assert (row.total_orders, row.total_units) == (row.o, row.u)
        assert row.total_revenue - row.total_profit == row.total_cost


def test_totals_of_the_larger_tables(spark):
    folder = "/root/testdata/sf0.01"
    rows = enrich.with_cost(
        enrich.with_product(star.transactions(spark, folder), star.products(spark, folder))
    )
    totals = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.sum("revenue").alias("revenue"), F.sum("cost").alias("cost"),
        F.count_if(F.col("profit") < 0).alias("losses"), F.count_if("is_returned").alias("returned"),
        F.count_if(F.col("campaign").isNull()).alias("no_campaign"),
    ).first()
    assert tuple(totals) == (
        60_000, Decimal("3024008723.09"), Decimal("1447849638.00"), 13_999, 20_046, 12_056,
    )


def test_null_keys_do_not_count_as_duplicates_of_known_ones(star_tables):
    assert quality.duplicate_keys(star_tables[1], "customer_id").isEmpty()
    assert quality.duplicate_keys(star_tables[2], "product_id").isEmpty()
