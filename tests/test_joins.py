from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import joins


@pytest.fixture(scope="module")
def fact(spark):
    """A third of the rows have key 7, a tenth none, key 999 is unknown."""
    key = (
        F.when(F.col("id") % 3 == 0, 7)
        .when(F.col("id") % 10 == 1, None)
        .when(F.col("id") % 10 == 2, 999)
        .otherwise(F.col("id") % 100)
    )
    return spark.range(30_000).select(F.col("id").alias("row"), key.cast("bigint").alias("key"))


@pytest.fixture(scope="module")
def dimension(spark):
    return spark.range(100).select(
        F.col("id").alias("key"), F.concat(F.lit("name "), "id").alias("name")
    )


def rows(frame):
    return sorted(map(tuple, frame.select("row", "key", "name").collect()))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_lookup_equals_plain_join(fact, dimension, how):
    salted = joins.salted_lookup(fact, dimension, "key", how, ["row"])
    assert rows(salted) == rows(fact.join(dimension, "key", how))


def test_repeated_dimension_keys_multiply_rows_on_both_routes(fact, dimension):
    twice = dimension.unionByName(dimension.where("key < 10"))
    salted = joins.salted_lookup(fact, twice, "key", "left", ["row"])
    assert rows(salted) == rows(fact.join(twice, "key", "left"))


def test_only_keys_that_overfill_a_partition_are_hot(fact):
    # 10,000 of the 28,000 keyed rows fill 2.9 of 8 partitions
    assert [tuple(row) for row in joins.hot_keys(fact, "key").collect()] == [(7, 4)]


def test_no_hot_keys_among_even_ones(spark):
    even = spark.range(50_000).select((F.col("id") % 10_000).alias("key"))
    assert joins.hot_keys(even, "key").isEmpty()


def test_hot_rows_spread_over_partitions(spark, fact, dimension):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salted = joins.salted_lookup(fact, dimension, "key", "left", ["row"])
        sizes = [r["count"] for r in salted.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 30_000
    assert max(sizes) < 2 * 30_000 / 8


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_lookup_broadcasts_only_below_the_limit(spark, fact, dimension):
    small = joins.lookup(fact, dimension, "key", spread_by=["row"])
    assert "BroadcastHashJoin [key" in plan(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100b")
    try:
        large = joins.lookup(fact, dimension, "key", spread_by=["row"])
        assert "salt" in plan(large)
        assert rows(large) == rows(small)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
