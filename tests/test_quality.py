from __future__ import annotations

from decimal import Decimal

import pytest

from tallyworks.operators import quality

SCHEMA = "transaction_id string, campaign string, quantity int, revenue decimal(12,2)"


@pytest.fixture(scope="module")
def dirty(spark):
    good = ("a", "x", 1, Decimal("10.00"))
    return spark.createDataFrame(
        [
            good,
            good,
            good,
            ("b", None, 2, Decimal("5.00")),
            ("b", None, 2, Decimal("5.00")),
            ("c", "x", 2, Decimal("-1.00")),
            ("d", "x", 0, Decimal("3.00")),
            ("e", "x", -4, Decimal("-3.00")),
            ("f", "x", None, Decimal("0.00")),
            ("g", None, 1, None),
        ],
        SCHEMA,
    )


def ids(frame):
    return sorted(row.transaction_id for row in frame.collect())


def test_null_counts_cover_rows_as_loaded(dirty):
    found = quality.null_counts(quality.collapse_duplicates(dirty)).collect()
    assert {r.column_name: r.nulls for r in found} == {"campaign": 3, "quantity": 1, "revenue": 1}


def test_duplicates_collapse_with_nulls_equal(dirty):
    assert ids(quality.drop_duplicates(dirty)) == list("abcdefg")
    copies = {r.transaction_id: r.copies for r in quality.collapse_duplicates(dirty).collect()}
    assert copies["a"] == 3 and copies["b"] == 2 and copies["c"] == 1


def test_bad_rows_go_and_unknown_values_stay(dirty):
    assert ids(quality.drop_negative_revenue(dirty)) == list("aaabbdfg")
    assert ids(quality.drop_non_positive_quantity(dirty)) == list("aaabbcfg")
    assert ids(quality.validate(dirty)) == list("abfg")


def test_rules_apply_in_order(dirty):
    counts = quality.validation_counts(quality.collapse_duplicates(dirty)).first().asDict()
    assert counts == {
        "loaded": 10,
        "duplicates": 3,
        "negative_revenue": 2,
        "non_positive_quantity": 1,
        "remaining": 4,
        "removed": 6,
    }


def test_nothing_loaded(spark):
    empty = quality.collapse_duplicates(spark.createDataFrame([], SCHEMA))
    assert quality.validation_counts(empty).first().loaded == 0
    assert quality.null_counts(empty).isEmpty()


def test_duplicate_keys(dirty):
    found = quality.duplicate_keys(dirty, "transaction_id").collect()
    assert {r.transaction_id: r.copies for r in found} == {"a": 3, "b": 2}
