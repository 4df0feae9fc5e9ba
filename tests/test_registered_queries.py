"""Every registered query equals its SQL, value for value."""

from __future__ import annotations

import pytest

import __spark_entry__
from checks import compare, oracle, registry

QUERIES = registry.queries()


@pytest.fixture(scope="module")
def database(folder):
    return compare.connect(folder)


def test_each_query_has_sql_and_the_other_way_round():
    assert set(QUERIES) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, folder, database, name):
    frame = QUERIES[name](spark, folder)
    mine = compare.canonical(frame.columns, [tuple(row) for row in frame.collect()])
    result = database.execute(oracle.oracle_sql()[name])
    columns = [column[0] for column in result.description]
    theirs = compare.canonical(columns, result.fetchall())
    assert sorted(columns) == sorted(frame.columns)
    assert len(mine) == len(theirs) > 0
    assert compare.differences(mine, theirs) == []


def test_entry_is_the_monthly_report(spark):
    report = __spark_entry__.entry(spark)
    assert report.columns[:5] == ["year", "month", "month_name", "quarter", "period"]
    assert report.count() == 80
