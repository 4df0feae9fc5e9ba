"""Refreshed months, pruned reads, lookup misses, sketches, observed audits and bucketed joins."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyworks import schemas
from tallyworks.functions.calendar import date_features
from tallyworks.operators import enrich, quality, sketches
from tallyworks.operators.summaries import MONTH
from tallyworks.plans import etl, refresh
from tallyworks.session import scratch_path
from tallyworks.sinks.tables import write_bucketed, write_table
from tallyworks.sources import files, stored


def sale(number: int, day: dt.date | None, revenue: int, customer: int = 1, product: int = 1) -> tuple:
    amount = Decimal(revenue).quantize(Decimal("0.01"))
    return (
        f"TXN{number:07d}", day, f"CUST{customer:05d}", f"PROD{product:04d}", "Online", "Sale", 1, amount, 0,
        Decimal("0.00"), amount, Decimal("1.00"), amount - 1, False, "Completed",
    )


def sales(spark, rows):
    return spark.createDataFrame(rows, schemas.TRANSACTIONS)


@pytest.fixture(scope="module")
def dimensions(spark):
    people = [(f"CUST{n:05d}", f"Name {n}", "City", "North", "SME", None, None) for n in range(1, 6)]
    goods = [(f"PROD{n:04d}", f"Thing {n}", "Books", Decimal("9.00"), Decimal("1.00"), 0.1) for n in range(1, 4)]
    return spark.createDataFrame(people, schemas.CUSTOMERS), spark.createDataFrame(goods, schemas.PRODUCTS)


def year_of_sales(chance: random.Random, high: int = 1_000) -> list[tuple]:
    return [
        sale(n, dt.date(2022, 1, 1) + dt.timedelta(days=n % 365), chance.randrange(1, high), n % 5 + 1, n % 3 + 1)
        for n in range(900)
    ]


def files_by_month(root: str) -> dict[str, set[str]]:
    found: dict[str, set[str]] = {}
    for path in Path(root, "transactions").rglob("*.parquet"):
        found.setdefault(f"{path.parent.parent.name}/{path.parent.name}", set()).add(path.name)
    return found


def same_rows(left, right) -> bool:
    assert left.columns == right.columns
    return sorted(map(str, left.collect())) == sorted(map(str, right.collect()))


def test_refreshed_months_equal_a_rebuild_and_leave_other_files(spark, dimensions):
    chance = random.Random(1)
    root = scratch_path(spark, "refresh")
    rows = year_of_sales(chance)
    ledger = write_table(enrich.enrich(sales(spark, rows), *dimensions), root, "transactions", MONTH)
    before = files_by_month(root)
    # the same revenues in other rows: the cutoff stays, so no other month changes
    changed = [r[:2] + ("CUST00002",) + r[3:] if r[1].month in (3, 4) else r for r in rows]
    months = sales(spark, [r for r in changed if r[1].month in (3, 4)])
    done = refresh.refresh_months(months, *dimensions, ledger, root)
    assert same_rows(done.ledger, enrich.enrich(sales(spark, changed), *dimensions))
    assert {(r.year, r.month) for r in done.months.collect()} == {(2022, 3), (2022, 4)}
    assert done.restated.isEmpty()
    after = files_by_month(root)
    assert {m for m in before if before[m] != after[m]} == {"year=2022/month=3", "year=2022/month=4"}
    assert set(after) == set(before) and len(after) == 12


def test_a_moved_cutoff_restates_only_months_with_rows_that_change_sides(spark, dimensions):
    root = scratch_path(spark, "refresh")
    rows = [sale(n, dt.date(2022, n % 10 + 1, 5), 100 + n) for n in range(100)]
    ledger = write_table(enrich.enrich(sales(spark, rows), *dimensions), root, "transactions", MONTH)
    before = files_by_month(root)
    changed = [sale(500 + n, r[1], 10_000 + n) if n in (0, 10) else r for n, r in enumerate(rows)]
    done = refresh.refresh_months(sales(spark, [r for r in changed if r[1].month == 1]), *dimensions, ledger, root)
    rebuilt = enrich.enrich(sales(spark, changed), *dimensions)
    assert same_rows(done.ledger, rebuilt)
    restated = {(r.year, r.month) for r in done.restated.collect()}
    after = files_by_month(root)
    assert restated == {(2022, 2)}
    assert {m for m in before if before[m] != after[m]} == {f"year={y}/month={m}" for y, m in restated | {(2022, 1)}}


def test_new_months_rows_without_date_and_faulty_rows(spark, dimensions):
    root = scratch_path(spark, "refresh")
    rows = [sale(n, dt.date(2022, 1 + n % 3, 2), 50 + n) for n in range(30)] + [sale(90, None, 70)]
    ledger = write_table(enrich.enrich(sales(spark, rows), *dimensions), root, "transactions", MONTH)
    new = [sale(100 + n, dt.date(2023, 5, 2), 20 + n) for n in range(10)] + [sale(200, None, 99), sale(201, None, 1)]
    faulty = [new[0], sale(300, dt.date(2023, 5, 3), -4)]
    done = refresh.refresh_months(sales(spark, new + faulty), *dimensions, ledger, root)
    kept = [r for r in rows if r[1] is not None] + new
    assert same_rows(done.ledger, enrich.enrich(sales(spark, kept), *dimensions))
    again = refresh.refresh_months(sales(spark, new), *dimensions, done.ledger, root)
    assert same_rows(again.ledger, enrich.enrich(sales(spark, kept), *dimensions))


def test_pruned_reads(spark, dimensions):
    root = scratch_path(spark, "pruned")
    schema = write_table(
        enrich.enrich(sales(spark, year_of_sales(random.Random(2))), *dimensions), root, "transactions", MONTH
    ).schema
    ledger = stored.read_ledger(spark, root, schema)
    quarter = stored.between_months(ledger, (2022, 4), (2022, 6))
    plan = quarter._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "DataFilters: []" in plan
    assert {r.month for r in quarter.select("month").distinct().collect()} == {4, 5, 6}
    read = quarter.select(F.input_file_name().alias("path")).distinct().collect()
    assert len({Path(r.path).parent for r in read}) == 3
    across = stored.between_months(ledger, (2021, 11), (2022, 2))
    assert {r.month for r in across.select("month").distinct().collect()} == {1, 2}
    calendar = write_table(
        ledger.groupBy(*MONTH).agg(F.first("quarter").alias("quarter")), root, "calendar"
    )
    joined = stored.of_months(ledger, calendar.where("quarter = 2"))
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString().lower()
    assert same_rows(joined, quarter)


def test_unmatched_keys(spark, dimensions):
    rows = [sale(n, dt.date(2022, 1, 1), 5, customer=9, product=1) for n in range(400)]
    rows += [sale(500, dt.date(2022, 1, 1), 5, customer=1, product=8)]
    rows += [(*sale(501, dt.date(2022, 1, 1), 5)[:2], None, *sale(501, None, 5)[3:])]
    people, goods = dimensions
    twice = people.unionByName(people)
    found = {tuple(r) for r in etl.lookup_misses(sales(spark, rows), twice, goods).collect()}
    assert found == {("customers", "CUST00009", 400), ("customers", None, 1), ("products", "PROD0008", 1)}
    assert quality.unmatched_keys(sales(spark, []), people, "customer_id", "customers").collect() == []
    ledger = enrich.enrich(sales(spark, rows), people, goods)
    assert ledger.where("region IS NULL").count() == 401


def test_unmatched_keys_collapse_before_they_are_shuffled(spark, dimensions):
    plan = quality.unmatched_keys(sales(spark, [sale(1, None, 5)]), dimensions[0], "customer_id", "c")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("LeftAnti") < text.index("partial_count")


def test_sketches_of_months_merge_to_quarters_and_years(spark):
    chance = random.Random(3)
    rows = [
        sale(n, dt.date(2022 + n % 2, n % 12 + 1, 3), chance.randrange(1, 100_000), chance.randrange(3_000))
        for n in range(12_000)
    ]
    rows.append((*sale(1, dt.date(2022, 1, 1), 5)[:2], None, *sale(1, None, 5)[3:10], None, *sale(1, None, 5)[11:]))
    ledger = sales(spark, rows).withColumns(date_features(F.col("date")))
    sketched = sketches.monthly_sketches(ledger)
    assert sketched.count() == 12 and sketched.columns == [*MONTH, "customers", "revenues", "quarter"]
    for keys in (["year", "quarter"], ["year"], []):
        exact = ledger.groupBy(*keys).agg(F.count_distinct("customer_id").alias("exact"))
        found = sketches.approximate_customers(sketched, keys)
        for r in (exact.join(found, keys) if keys else exact.crossJoin(found)).collect():
            assert abs(r.approx_customers - r.exact) <= 4 * sketches.CUSTOMER_ERROR * r.exact
    revenues = sorted(r[10] for r in rows if r[10] is not None)
    [row] = sketches.approximate_quantile(sketched, 0.9).collect()
    rank = sum(v <= row.approx_threshold for v in revenues) / len(revenues)
    assert abs(rank - 0.9) <= 2 * sketches.RANK_ERROR


def test_sketches_leave_out_returned_customers_but_not_their_revenue(spark):
    kept = sale(1, dt.date(2022, 1, 1), 10, customer=1)
    gone = (*sale(2, dt.date(2022, 1, 1), 90, customer=2)[:13], True, "Returned")
    sketched = sketches.monthly_sketches(sales(spark, [kept, gone]).withColumns(date_features(F.col("date"))))
    assert sketches.approximate_customers(sketched, ["year"]).first().approx_customers == 1
    assert sketches.approximate_quantile(sketched, 1.0).first().approx_threshold == 90


def test_observed_audit_reads_the_copy_no_more(spark, dimensions):
    rows = year_of_sales(random.Random(4))
    rows += rows[:7] + [sale(2_000, None, -5), sale(2_001, None, 5)]
    collapsed, observed = etl.collapse_observed(sales(spark, rows))
    stored_tables = etl.store_tables(collapsed, *dimensions, scratch_path(spark, "tables"))
    counted = etl.audit(collapsed, stored_tables)
    watched = etl.audit(collapsed, stored_tables, observed)
    assert same_rows(watched, counted)
    copy = set(collapsed.inputFiles())
    assert copy & set(counted.inputFiles()) and not copy & set(watched.inputFiles())


def test_observed_audit_of_no_rows(spark):
    _, observed = etl.collapse_observed(sales(spark, []))
    found = {(r.stage, r.metric): r.value for r in etl.observed_audit(spark, observed).collect()}
    assert found["validate", "loaded"] == 0 and set(found.values()) == {0} and len(found) == 6


def test_bucketed_sides_join_without_an_exchange(spark, dimensions):
    root = scratch_path(spark, "buckets")
    rows = sales(spark, year_of_sales(random.Random(5)))
    left = write_bucketed(rows, root, "bucketed_sales", "customer_id", 4)
    right = write_bucketed(dimensions[0], root, "bucketed_people", "customer_id", 4)
    joined = left.join(right.hint("merge"), "customer_id", "left")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == 900 and joined.where("region = 'North'").count() == 900
    # written again, also with other rows, the table is replaced
    again = write_bucketed(rows.limit(10), root, "bucketed_sales", "customer_id", 4)
    assert again.count() == 10


NAMES = schemas.PRODUCTS.fieldNames()


def test_columns_go_by_name_and_records_may_span_lines(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        'remark,cost_price,return_rate,category,product_name,unit_price,product_id\n'
        'x,7.00,0.5,Books,"A ""fine""\nlong, name",9.50,PROD0001\n'
        'y,abc,,Toys,plain,1.00,PROD0002\n'
        ',1.00,0.1,Toys,other,2.00,PROD0003\n'
    )
    first, third = files.read_products(spark, f"{tmp_path}/p.csv", multiline=True).orderBy("product_id").collect()
    assert first.asDict() == {
        "product_id": "PROD0001", "product_name": 'A "fine"\nlong, name', "category": "Books",
        "unit_price": Decimal("9.50"), "cost_price": Decimal("7.00"), "return_rate": 0.5,
    }
    assert third.product_id == "PROD0003"
    checked = files.read_checked(spark, f"{tmp_path}/p.csv", schemas.PRODUCTS, multiline=True)
    [bad] = files.quarantined(checked).collect()
    assert bad.faults == ["cost_price"] and bad.source.product_id == "PROD0002"
    # without it, both halves of the broken record have faults and no other row is lost
    split = files.read_checked(spark, f"{tmp_path}/p.csv", schemas.PRODUCTS).persist()
    assert "PROD0003" in {r.product_id for r in files.accepted(split).collect()}
    assert files.accepted(split).count() + files.quarantined(split).count() == 4


def test_part_files_of_another_order_fail(spark, tmp_path):
    (tmp_path / "part-1.csv").write_text(",".join(NAMES) + "\nPROD0001,a,Books,1.00,1.00,0.1\n")
    (tmp_path / "part-2.csv").write_text(",".join(reversed(NAMES)) + "\n0.1,1.00,1.00,Books,a,PROD0001\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_products(spark, str(tmp_path)).collect()


def test_missing_columns_are_named(spark, tmp_path):
    (tmp_path / "p.csv").write_text("product_id,category\nPROD0001,Books\n")
    with pytest.raises(ValueError, match="header lacks the columns product_name, unit_price"):
        files.read_products(spark, f"{tmp_path}/p.csv")
