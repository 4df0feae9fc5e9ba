"""Files in, tables, exports, views and forecasts out."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from tallyworks import schemas
from tallyworks.plans import etl
from tallyworks.session import scratch_path
from tallyworks.sinks import tables as sinks
from tallyworks.sinks.views import register_views
from tallyworks.sources import files

HEADER = ",".join(schemas.TRANSACTIONS.fieldNames())


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    folder = tmp_path_factory.mktemp("source")
    rng = random.Random(5)
    lines = []
    for i in range(4_000):
        day = dt.date(2022, 1, 1) + dt.timedelta(days=rng.randrange(1_095))
        quantity, price = rng.randint(1, 5), rng.randint(500, 90_000) / 100
        revenue, cost = round(price * quantity, 2), round(price * quantity * 0.7, 2)
        returned = rng.random() < 0.1
        campaign = rng.choice(["Summer Sale", "Diwali Offer", "None"])
        status = "Returned" if returned else rng.choice(["Completed", "Pending"])
        lines.append(
            f"TXN{i:07d},{day},CUST{rng.randint(1, 40):05d},PROD{rng.randint(1, 12):04d},Online,"
            f"{campaign},{quantity},{price:.2f},0,0.0,{revenue:.2f},{cost:.2f},"
            f"{revenue - cost:.2f},{returned},{status}"
        )
    lines += lines[:25]
    lines.append("TXN9000000,2022-05-05,CUST00001,PROD0001,Online,None,1,5.00,0,0.0,-5.00,1.00,-6.00,False,Completed")
    lines.append("TXN9000001,2022-05-05,CUST00001,PROD0001,Online,None,0,5.00,0,0.0,5.00,1.00,4.00,False,Completed")
    (folder / "transactions.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    people = [f"CUST{i:05d},Name {i},City,{'North' if i % 2 else 'South'},SME,2020-01-01,a@b.c" for i in range(1, 41)]
    (folder / "customers.csv").write_text("\n".join([",".join(schemas.CUSTOMERS.fieldNames()), *people]) + "\n")
    goods = [f"PROD{i:04d},Thing {i},{'Books' if i % 3 else 'Sports'},10.00,7.00,0.1" for i in range(1, 13)]
    (folder / "products.csv").write_text("\n".join([",".join(schemas.PRODUCTS.fieldNames()), *goods]) + "\n")
    return folder


@pytest.fixture(scope="module")
def inputs(spark, source):
    return (
        files.read_transactions(spark, f"{source}/transactions.csv"),
        files.read_customers(spark, f"{source}/customers.csv"),
        files.read_products(spark, f"{source}/products.csv"),
    )


@pytest.fixture(scope="module")
def run(spark, inputs):
    target = scratch_path(spark, "run")
    return target, etl.run_etl(*inputs, target), etl.run_forecast(spark, target)


def test_null_tokens_and_types(inputs):
    rows = inputs[0]
    assert rows.schema == schemas.TRANSACTIONS
    assert rows.where("campaign = 'None'").isEmpty()
    assert rows.where("campaign IS NULL").count() > 1_000
    assert rows.where("is_returned").count() > 100


def test_header_that_differs_is_refused(spark, tmp_path):
    (tmp_path / "products.csv").write_text("product_id,category\nPROD0001,Books\n")
    with pytest.raises(Exception, match="header|column|schema"):
        files.read_products(spark, f"{tmp_path}/products.csv").collect()


def test_quotes_commas_and_unreadable_numbers(spark, tmp_path):
    (tmp_path / "products.csv").write_text(
        ",".join(schemas.PRODUCTS.fieldNames()) + "\n"
        'PROD0001,"Pen, ""fine""",n/a,NA,7.00,NaN\n'
        "PROD0002,,Books,12.50,,0.1\n"
    )
    first, second = files.read_products(spark, f"{tmp_path}/products.csv").collect()
    assert (first.product_name, first.category, first.unit_price) == ('Pen, "fine"', None, None)
    assert first.cost_price == 7 and first.return_rate is None
    assert second.product_name is None and second.cost_price is None
    path = sinks.write_csv(files.read_products(spark, f"{tmp_path}/products.csv"), str(tmp_path), "out")
    assert '"Pen, ""fine"""' in "".join(p.read_text() for p in tmp_path.glob("out/*.csv"))
    assert files.read_products(spark, path).first().product_name == 'Pen, "fine"'


def test_audit(run):
    found = {(r.stage, r.metric): r.value for r in run[1]["etl_audit"].collect()}
    assert found["validate", "loaded"] == 4_027
    assert found["validate", "duplicates"] == 25
    assert found["validate", "negative_revenue"] == 1
    assert found["validate", "non_positive_quantity"] == 1
    assert found["validate", "remaining"] == found["load", "transactions"] == 4_000
    assert found["validate", "removed"] == 27
    assert found["load", "monthly_summary"] == 36
    assert found["load", "category_summary"] == 72
    assert found["nulls", "campaign"] > 0 and ("nulls", "revenue") not in found


def test_ledger_is_partitioned_by_month_and_pruned(spark, run):
    ledger = spark.read.parquet(f"{run[0]}/tables/transactions")
    one_month = ledger.where("year = 2023 AND month = 5")
    plan = one_month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert one_month.count() == run[1]["transactions"].where("year = 2023 AND month = 5").count() > 0


def test_exports_equal_tables(spark, run):
    target, stored, _ = run
    for name in ["monthly_summary", "category_summary", "region_summary", "channel_summary"]:
        read = spark.read.schema(stored[name].schema).option("header", True).csv(f"{target}/csv/{name}")
        assert sorted(map(str, read.collect())) == sorted(map(str, stored[name].collect()))
    clean = spark.read.option("header", True).csv(f"{target}/csv/transactions_clean")
    assert clean.count() == 4_000 and clean.columns == schemas.LEDGER_COLUMNS


def test_views_answer_sql(spark, run):
    names = register_views(run[1], dt.date(2025, 1, 1))
    assert sum(name.startswith("vw_") for name in names) == 6 and len(names) == 14
    assert spark.sql("SELECT count(*) c FROM transactions").first().c == 4_000
    months = spark.sql("SELECT * FROM vw_monthly_kpis").collect()
    assert [r.period for r in months] == sorted(r.period for r in months) and len(months) == 36
    assert spark.sql("SELECT count(*) c FROM vw_customer_rfm").first().c == 40
    assert spark.sql("SELECT sum(total_orders) c FROM vw_top_products").first().c == sum(
        r.total_orders for r in months
    )


def test_forecast_exports(spark, run):
    target, _, results = run
    detail = spark.read.option("header", True).csv(f"{target}/csv/forecast_detail")
    assert detail.columns == ["period", "type", "ma_3_forecast", "lr_forecast", "ensemble_forecast"]
    assert [r.period for r in detail.collect()] == [f"2025-{m:02d}" for m in range(1, 7)]
    both = spark.read.option("header", True).csv(f"{target}/csv/revenue_actuals_vs_forecast")
    assert both.columns == ["period", "type", "revenue"] and both.count() == 42
    assert results["forecast_metrics"].first().train_rows == 26


def test_a_second_run_replaces_the_first(spark, inputs, run):
    target = run[0]
    before = run[1]["transactions"].count()
    fewer = inputs[0].where("date < '2023-01-01'")
    for rows in (fewer, inputs[0]):
        stored = etl.store_tables(etl.collapse(rows), inputs[1], inputs[2], f"{target}/again")
    assert stored["transactions"].count() == before
    assert stored["monthly_summary"].count() == 36


def test_repeated_customers_multiply_rows_and_move_the_cutoff(spark, inputs):
    transactions, customers, products = inputs
    twice = customers.unionByName(customers.where("customer_id <= 'CUST00003'"))
    assert etl.keys_are_unique(customers, products)
    assert not etl.keys_are_unique(twice, products)
    ledger = etl.enriched_ledger(transactions, twice, products)
    extra = transactions.where("customer_id <= 'CUST00003'").count()
    assert ledger.count() == transactions.count() + extra


def test_jdbc_target_limits_its_writers():
    options = sinks.jdbc_options("jdbc:postgresql://host/sales", "monthly_summary", user="me")
    assert options["numPartitions"] == "32" and options["user"] == "me"
    assert options["dbtable"] == "monthly_summary"
