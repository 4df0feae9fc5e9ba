"""Registered queries equal their SQL, on the given tables and on odd ones."""

from __future__ import annotations

import __spark_entry__
import pytest
from checks import compare
from tallyworks.llm import chat, decontaminate, imatch, mixing, queries, sql


def assert_same(frame, connection, text):
    mine = compare.canonical(frame.columns, [tuple(row) for row in frame.collect()])
    result = connection.execute(text)
    columns = [column[0] for column in result.description]
    theirs = compare.canonical(columns, result.fetchall())
    assert sorted(columns) == sorted(frame.columns)
    assert len(mine) == len(theirs)
    assert compare.differences(mine, theirs) == []


@pytest.mark.parametrize("name", sql.oracle_sql())
def test_query_equals_sql(spark, folder, name):
    assert_same(
        queries.queries()[name](spark, folder), compare.connect(folder), sql.oracle_sql()[name]
    )


def test_entry_registers_one_query_an_operator_and_the_pipeline():
    names = [name for name in __spark_entry__.queries() if name.startswith("op")]
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()
    assert set(sql.oracle_sql()) <= set(__spark_entry__.oracle_sql())


def connection_with(tmp_path, **frames):
    import duckdb

    connection = duckdb.connect()
    for name, frame in frames.items():
        frame.write.parquet(str(tmp_path / name))
        connection.execute(f"CREATE VIEW {name} AS FROM '{tmp_path / name}/*.parquet'")
    return connection


@pytest.mark.parametrize("table", ["odd", "empty"])
def test_odd_documents_equal_sql(request, spark, tmp_path, table):
    documents = request.getfixturevalue(table)
    benchmark = spark.createDataFrame(
        [(1, "fox jumps over one lazy dog and runs through a green"), (1, "ONE"), (2, None)]
        + [(None, "words"), (3, ""), (4, "fox jumps over one lazy dog and runs through a green")],
        "item_id long, text string",
    )
    connection = connection_with(tmp_path, documents=documents, benchmark=benchmark)
    assert_same(mixing.mixing_report(documents), connection, sql.source_mixing())
    assert_same(
        decontaminate.contamination_report(documents, benchmark),
        connection,
        sql.benchmark_decontamination(),
    )
    assert_same(imatch.fingerprint_report(documents), connection, sql.imatch_fingerprints())


def test_odd_conversations_equal_sql(spark, tmp_path):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "hello"),
        (2, 0, "user", "hi"), (2, 1, "assistant", "hello"), (2, 2, "user", "more"),
        (3, 0, "user", "hi"), (3, 1, "assistant", "hello"), (3, 2, "user", "more"),
        (4, 0, "user", "hi"), (4, 0, "user", "hi"), (4, 1, None, None),
        (5, 5, "user", "hi"), (5, None, "user", "hi"), (None, 0, "user", "who"),
        (6, 0, "", ""), (7, 0, "user", "x"), (7, 0, "tool", "y"),
        *[(8, turn, "user", f"turn {turn}") for turn in range(700)],
        *[(9, turn * 100, "user", f"turn {turn}") for turn in range(600)],
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    connection = connection_with(tmp_path, conversations=table)
    assert_same(chat.format_chats(table), connection, sql.chat_snapshots())
    kept = {row.conv_id for row in chat.format_chats(table).collect()}
    assert kept == {2, 4, 5, None, 6, 7, 8}
    assert chat.format_chats(table.limit(0)).collect() == []


def test_chat_ignores_clashing_columns(spark):
    schema = "conv_id long, turn long, role string, text string, place int, block int, turns int"
    table = spark.createDataFrame([(1, 0, "user", "hi", 9, 9, 9)], schema)
    [row] = chat.format_chats(table).collect()
    assert row.rendered == "<|im_start|>user\nhi<|im_end|>\n" and row.n_turns == 1


def test_hot_conversations_spread_over_parts_and_equal_sql(spark, tmp_path):
    nameless = [(None, row % 5, "user", f"{row} " * (row % 7)) for row in range(600)]
    copies = [(3, 0, "user", "again")] * 600
    others = [(4 + row // 3, row % 3, "user", f"turn {row % 9}") for row in range(600)]
    long = [(1, 0, "user", "word " * 400_000), (1, 1, "assistant", None)]
    table = spark.createDataFrame(
        nameless + copies + others + long, "conv_id long, turn long, role string, text string"
    )
    connection = connection_with(tmp_path, conversations=table)
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        turns = chat.ordered_turns(table).where("conv.conv_id IS NULL")
        sizes = [row["count"] for row in turns.groupBy("part").count().collect()]
        assert len(sizes) > 1 and max(sizes) < 400
        assert_same(chat.format_chats(table), connection, sql.chat_snapshots())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_copies_meet_before_they_are_shuffled(spark):
    table = spark.createDataFrame([(1, 0, "user", "again")] * 5000, "conv_id long, turn long, role string, text string")
    assert chat.fewer_copies(table).count() <= 2 * table.rdd.getNumPartitions()
