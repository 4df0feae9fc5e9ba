"""Inputs that the given tables do not hold: bad fields, odd keys, large totals, left-over files."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyworks import schemas
from tallyworks.functions.rounding import exact_ratio, half_up
from tallyworks.operators import joins, reports, series
from tallyworks.plans import early, etl
from tallyworks.session import scratch_below, scratch_path, settle
from tallyworks.sources import files, star

HEADER = ",".join(schemas.TRANSACTIONS.fieldNames())
GOOD = "T1,2022-01-01,C1,P1,web,None,2,5.00,0,0.00,10.00,4.00,6.00,False,Completed"


@pytest.fixture
def checked(spark, tmp_path):
    lines = [
        HEADER,
        GOOD,
        GOOD.replace("2022-01-01", "2022-01-01 10:20:30").replace("T1", "T2"),
        GOOD.replace("10.00", "abc").replace("T1", "T3"),
        GOOD.replace("10.00", "12345678901234.00").replace("T1", "T4"),
        GOOD.replace(",2,", ",2.5,").replace("T1", "T5"),
        GOOD.replace(",2,", ",3.0,").replace("T1", "T6"),
        GOOD.replace("10.00", "NaN").replace("T1", "T7"),
        GOOD.replace("2022-01-01", "soon").replace("T1", "T8"),
        GOOD.replace("T1", "T9") + ",one more field",
    ]
    path = tmp_path / "transactions.csv"
    path.write_text("\n".join(lines))
    return files.read_checked(spark, str(path), schemas.TRANSACTIONS)


def test_unreadable_fields_are_set_apart_not_lost(checked):
    faults = {r.source.transaction_id: r.faults for r in files.quarantined(checked).collect()}
    assert faults.pop("T9") == [files.CORRUPT]
    assert faults == {"T3": ["revenue"], "T4": ["revenue"], "T5": ["quantity"], "T8": ["date"]}
    rows = {r.transaction_id: r for r in files.accepted(checked).collect()}
    assert sorted(rows) == ["T1", "T2", "T6", "T7"]
    assert rows["T2"].date == dt.date(2022, 1, 1)
    assert rows["T6"].quantity == 3 and rows["T7"].revenue is None and rows["T1"].campaign is None


def test_quarantine_is_stored_and_counted(spark, checked, tmp_path):
    customers = spark.createDataFrame([], schemas.CUSTOMERS)
    products = spark.createDataFrame([], schemas.PRODUCTS)
    target = str(tmp_path / "out")
    rejected = {"transactions": files.quarantined(checked)}
    stored = etl.run_etl(files.accepted(checked), customers, products, target, rejected)
    audit = {(r.stage, r.metric): r.value for r in stored["etl_audit"].collect()}
    assert audit["quarantine", "transactions"] == 5
    assert audit["validate", "loaded"] == 4
    assert stored["quarantine_transactions"].count() == 5
    assert sorted(os.listdir(target)) == ["csv", "tables"]


def test_scratch_is_removed_after_a_failure(spark, tmp_path):
    with pytest.raises(RuntimeError), scratch_below(spark, str(tmp_path)):
        settle(spark.range(3), "copy")
        assert os.listdir(tmp_path)
        raise RuntimeError
    assert os.listdir(tmp_path) == []
    assert str(tmp_path) not in scratch_path(spark, "copy")


def test_ratios_round_once(spark):
    kind = "profit decimal(38,2), revenue decimal(32,2)"
    frame = spark.createDataFrame([(Decimal("12344999.99"), Decimal("100000000.00"))], kind)
    ratio = half_up(exact_ratio(F.col("profit") * F.lit(100), F.col("revenue")))
    assert frame.select(ratio.alias("r")).first().r == Decimal("12.34")


def test_both_routes_declare_the_same_types(spark, folder):
    sales, people = star.transactions(spark, folder), star.customers(spark, folder)
    goods = star.products(spark, folder)
    ledger = etl.enriched_ledger(sales, people, goods)
    routes = {
        "monthly_summary": early.monthly_summary(sales, goods),
        "category_summary": early.category_summary(sales, goods),
        "region_summary": early.region_summary(sales, people, goods),
        "channel_summary": early.channel_summary(sales),
    }
    for name, mine in routes.items():
        stored = etl.SUMMARIES[name](ledger)
        assert dict(mine.dtypes) == dict(stored.dtypes)


def test_no_sketch_of_all_splits_meets_in_one_task(spark):
    fact = spark.range(10_000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("key"))
    hot = joins.hot_keys(fact, "key")
    [row] = hot.collect()
    assert row.key == 7 and row.salts >= 2
    plan = hot._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" in plan
    assert joins.hot_keys(fact.limit(0), "key").collect() == []


def test_products_and_totals_scan_no_orders(spark, folder):
    lines, goods = star.priced_lines(spark, folder), star.products(spark, folder)
    for frame in (early.top_products(lines, goods), early.kpi_totals(lines, goods)):
        assert "o_orderkey" not in frame._jdf.queryExecution().optimizedPlan().toString()


def test_series_of_different_keys_have_different_names(spark):
    rows = [("a/b", "c", 1), ("a", "b/c", 2), ("a\\", "/", 3), ("a", "\\/", 4)]
    sales = spark.createDataFrame(
        [(x, y, 2024, 1, Decimal(n)) for x, y, n in rows],
        "x string, y string, year int, month int, revenue decimal(12,2)",
    )
    names = [r.series for r in series.keyed_series(sales, "x", "y").collect()]
    assert len(set(names)) == len(rows)
    plain = spark.createDataFrame([("p", "q", 2024, 1, Decimal(1))], sales.schema)
    assert series.keyed_series(plain, "x", "y").first().series == "p/q"


def test_matrix_has_every_segment(spark):
    region = spark.createDataFrame(
        [("E", "OLD", Decimal("2.00")), ("E", "NEWSEG", Decimal("5.00"))],
        "region string, segment string, revenue decimal(22,2)",
    )
    [row] = reports.region_segment_matrix(region).collect()
    assert row.NEWSEG == Decimal("5.00") and row.OLD == Decimal("2.00")
