"""What moves between tasks: rows are dealt once, and narrow."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from checks import registry
from tallyworks.operators import quality
from tallyworks.plans import etl
from tallyworks.session import scratch_path
from tallyworks.sinks import tables
from tallyworks.sources import star


@pytest.fixture
def no_broadcasts(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def shuffles(frame):
    """The rows' own exchanges by key; those of the sketch and of single rows are left out."""
    found = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan_of(frame))
    return [keys for keys in found if not keys.startswith(("_groupingexpression", "0#"))]


def test_collapsing_needs_no_shuffle_after_the_orders(spark, folder, no_broadcasts):
    rows, together = star.keyed_transactions(spark, folder)
    assert together == ["l_orderkey", "salt"]
    collapsed = quality.collapse_duplicates(rows, together)
    assert len(shuffles(collapsed)) == len(shuffles(rows)) == 2
    plain = quality.collapse_duplicates(star.transactions(spark, folder))
    assert collapsed.columns == plain.columns
    assert collapsed.exceptAll(plain).isEmpty() and plain.exceptAll(collapsed).isEmpty()


def test_faulty_rows_are_joined_and_shuffled_once(spark, folder, no_broadcasts):
    for name in ("distinct_transactions", "validated_transactions"):
        assert len(shuffles(registry.QUERIES[name](spark, folder))) == 2, name


def test_lines_are_dealt_to_their_orders_as_stored(spark, folder, no_broadcasts):
    plan = plan_of(star.transactions(spark, folder))
    assert "AS transaction_id" in plan[: plan.index("Exchange hashpartitioning(l_orderkey")]
    assert "AS transaction_id" not in plan[plan.index("Exchange hashpartitioning(l_orderkey") :]


def test_a_line_without_an_order_key_is_collapsed_by_a_shuffle(spark, folder, tmp_path):
    lines = star.read_table(spark, folder, "lineitem").limit(3)
    odd = lines.withColumns({"l_orderkey": F.lit(None).cast("long"), "l_partkey": F.lit(5).cast("long")})
    twin = odd.withColumns({"l_orderkey": F.lit(5).cast("long"), "l_suppkey": F.lit(None).cast("long")})
    same = {"l_suppkey": F.lit(5).cast("long"), "l_linenumber": F.lit(1)}
    # -, 5, 5, 1 and 5, 5, -, 1 have the same id
    rows = odd.withColumns(same).unionByName(twin.withColumn("l_linenumber", F.lit(1))).coalesce(1)
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = star.read_table(spark, folder, "orders").where("o_orderkey <> 5")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    frame, together = star.keyed_transactions(spark, str(tmp_path))
    assert together == [] and frame.columns == star.TRANSACTION_COLUMNS
    collapsed = quality.collapse_duplicates(frame, together)
    assert collapsed.count() == frame.distinct().count() == 3
    assert collapsed.agg(F.sum("copies")).first()[0] == 6


def test_a_refresh_gathers_the_new_rows_only(spark, folder, monkeypatch):
    """Restated rows of other months lie by month already."""
    from tallyworks.plans import etl, refresh

    counted = []
    gather = etl.gather_months
    monkeypatch.setattr(refresh, "gather_months", lambda rows: counted.append(rows.count()) or gather(rows))
    ledger = registry.refreshed_ledger(spark, folder)
    months = [f"(year = {y} AND month = {m})" for y, m in registry.REFRESHED]
    assert counted == [ledger.where(" OR ".join(months)).count()] and 0 < counted[0] < ledger.count()


def test_the_ledger_is_gathered_by_month_as_narrow_as_stored(spark, folder, no_broadcasts):
    plan = plan_of(registry.enriched_ledger(spark, folder, etl.gather_months))
    gathering = re.search(r"Exchange hashpartitioning\(year#\d+, month#\d+", plan).start()
    assert "AS transaction_id" in plan[:gathering]
    assert "AS transaction_id" not in plan[gathering : plan.index("Exchange hashpartitioning(l_orderkey")]


def rows_of(frame):
    columns = [F.col(c).cast("string") for c in sorted(frame.columns)]
    return sorted(tuple(map(str, row)) for row in frame.select(columns).collect())


def job_folder(spark, folder, target, change_lines, change_parts=lambda parts: parts):
    for name in ("region", "nation", "customer", "orders"):
        star.read_table(spark, folder, name).coalesce(1).write.parquet(f"{target}/{name}.parquet")
    change_parts(star.read_table(spark, folder, "part")).write.parquet(f"{target}/part.parquet")
    change_lines(star.read_table(spark, folder, "lineitem")).write.parquet(f"{target}/lineitem.parquet")
    return str(target)


def with_repeats(lines):
    """Lines twice, some under another flag that means the same, some that are no sales or lack a value."""
    odd = {
        "l_returnflag": F.when(F.col("l_orderkey") % 5 == 0, "?").otherwise(F.col("l_returnflag")),
        "l_quantity": F.when(F.col("l_orderkey") % 7 == 0, 0.0).otherwise(F.col("l_quantity")),
        "l_extendedprice": F.when(F.col("l_orderkey") % 11 != 0, F.col("l_extendedprice")),
    }
    again = lines.where("l_orderkey % 3 = 0")
    return lines.unionByName(again).unionByName(lines.withColumns(odd).where("l_orderkey % 2 = 0"))


def job_of_whole_rows(spark, folder):
    collapsed, observed = etl.collapse_observed(*star.keyed_transactions(spark, folder))
    people, goods = star.customers(spark, folder), star.products(spark, folder)
    tables = etl.store_tables(collapsed, people, goods, scratch_path(spark, "whole"))
    return tables, etl.audit(collapsed, tables, observed)


def assert_same_job(spark, target):
    collapsed, tables, counts = registry.run_job(spark, target, observe=True)
    whole, audit = job_of_whole_rows(spark, target)
    assert tables.keys() == whole.keys()
    for name in whole:
        assert tables[name].schema == whole[name].schema, name
        assert rows_of(tables[name]) == rows_of(whole[name]), name
    assert rows_of(etl.audit(collapsed, tables, counts)) == rows_of(audit)
    return collapsed


def stored_columns(spark, frame):
    return spark.read.parquet(*frame.inputFiles()).columns


def test_the_job_stores_and_moves_narrow_rows(spark, folder, tmp_path, no_broadcasts):
    target = job_folder(spark, folder, tmp_path, with_repeats)
    collapsed = assert_same_job(spark, target)
    # what follows from other columns is neither settled nor gathered
    kept = stored_columns(spark, collapsed)
    assert {"l_orderkey", "gross", "region", "category", "copies"} <= set(kept)
    assert not {"transaction_id", "revenue", "unit_price", "status", "fault"} & set(kept)


def test_the_job_collapses_whole_rows_where_ids_or_products_repeat(spark, folder, tmp_path):
    def unknown(lines):
        some = F.col("l_linenumber") == 1
        return lines.withColumn("l_suppkey", F.when(~some, F.col("l_suppkey")))

    def twice(parts):
        return parts.unionByName(parts.where("p_partkey % 10 = 0").withColumn("p_type", F.lit("OTHER")))

    targets = [
        job_folder(spark, folder, tmp_path / "null", lambda lines: unknown(with_repeats(lines))),
        job_folder(spark, folder, tmp_path / "twice", with_repeats, twice),
    ]
    for target in targets:
        collapsed = assert_same_job(spark, target)
        assert "transaction_id" in stored_columns(spark, collapsed)


def test_the_calendar_reads_the_stored_ledger_and_joins_nothing_again(spark, folder, monkeypatch):
    def refuse(*_):
        raise AssertionError("the lines are joined a second time")

    monkeypatch.setattr(registry, "monthly_summary", refuse)
    found = registry.ledger_by_calendar(spark, folder)
    assert rows_of(found) == rows_of(registry.ledger_of_a_quarter(spark, folder))


def test_csv_that_is_read_back_is_written_compressed(spark, folder):
    for name in ("transactions_from_csv", "exported_ledger"):
        files = registry.QUERIES[name](spark, folder).inputFiles()
        assert files and all(file.endswith(".csv.gz") for file in files), name


def test_rows_are_sorted_by_month_before_they_are_wide(spark, folder):
    """A partitioned write asks for this order and sorts whole rows where it does not find it."""
    ledger = registry.enriched_ledger(spark, folder, etl.gather_months)
    plan = ledger._jdf.queryExecution().optimizedPlan()
    order = plan.outputOrdering()
    assert [order.apply(i).child().name() for i in range(order.length())] == ["year", "month"]
    found = plan.toString()
    assert "AS discount_amount" not in found[found.index("Sort [year") :]


AT_ONCE = "spark.sql.maxConcurrentOutputFileWriters"


@pytest.fixture
def writes(spark, monkeypatch):
    """(folder's name, columns, partitions that a task may write at once) of every parquet write."""
    found = []
    write = DataFrameWriter.parquet

    def record(self, path, *args, **options):
        found.append((path.split("/")[-1], self._df.columns, spark.conf.get(AT_ONCE)))
        return write(self, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", record)
    return found


def test_the_refreshed_ledger_settles_narrow_rows(spark, folder, writes):
    registry.refreshed_ledger(spark, folder)
    [kept] = [columns for name, columns, _ in writes if name.startswith("rows-")]
    assert {"l_orderkey", "gross", "date", "region", "category"} <= set(kept)
    assert not {"transaction_id", "revenue", "unit_price", "status", "salt"} & set(kept)


def test_the_refreshed_ledger_is_written_without_a_sort_of_whole_rows(spark, folder, writes):
    before = spark.conf.get(AT_ONCE)
    registry.refreshed_ledger(spark, folder)
    assert [n for name, _, n in writes if name == "transactions"] == [str(tables.OPEN_PARTITIONS)] * 2
    assert {n for name, _, n in writes if name != "transactions"} == {before} == {spark.conf.get(AT_ONCE)}


def test_partitions_written_at_once_ask_for_no_order(spark, tmp_path):
    spark.sql(f"CREATE TABLE at_once (a INT, b INT) USING parquet PARTITIONED BY (b) LOCATION '{tmp_path}/t'")
    explain = "EXPLAIN INSERT OVERWRITE at_once SELECT 1 AS a, CAST(id % 3 AS INT) AS b FROM range(9)"
    try:
        assert "Sort [" in spark.sql(explain).first()[0]
        with tables.partitions_at_once(spark):
            assert "Sort [" not in spark.sql(explain).first()[0]
    finally:
        spark.sql("DROP TABLE at_once")


def test_more_partitions_than_a_task_writes_at_once_are_all_written(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "OPEN_PARTITIONS", 3)
    frame = spark.range(200).selectExpr("id", "int(id % 11) AS part").coalesce(1)
    first = tables.write_table(frame.where("part < 2"), str(tmp_path), "t", ["part"])
    assert first.count() == frame.where("part < 2").count()
    stored = tables.replace_partitions(frame, str(tmp_path), "t", ["part"], is_gathered=True)
    assert rows_of(stored) == rows_of(frame)
    assert len(stored.inputFiles()) == 11


def test_a_ledger_refreshed_from_narrow_rows_equals_one_from_whole_rows(spark, folder, tmp_path, monkeypatch):
    def odd(lines):
        unknown = {c: F.when(F.col("l_linenumber") != 2, F.col(c)) for c in ("l_partkey", "l_discount")}
        orphans = lines.where("l_orderkey % 9 = 0").withColumn("l_orderkey", F.lit(None).cast("long"))
        return with_repeats(lines.withColumns(unknown)).unionByName(orphans)

    target = job_folder(spark, folder, tmp_path, odd)
    narrow = rows_of(registry.refreshed_ledger(spark, target))
    monkeypatch.setattr(etl, "keys_are_unique", lambda *_: False)
    assert narrow == rows_of(registry.refreshed_ledger(spark, target)) != []
