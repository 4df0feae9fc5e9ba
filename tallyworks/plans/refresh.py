"""Refresh of single months in the stored ledger, equal to a full rebuild."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.operators import quality
from tallyworks.operators.enrich import HIGH_VALUE_FRACTION, enrich, with_date_features
from tallyworks.operators.quantile import quantile_cutoff
from tallyworks.operators.summaries import MONTH
from tallyworks.plans.etl import gather_months
from tallyworks.session import settle
from tallyworks.sinks.tables import replace_partitions


@dataclass
class Refresh:
    """The refreshed ledger, the months of the input, and other months whose flags had to change."""

    ledger: DataFrame
    months: DataFrame
    restated: DataFrame


def by_month(ledger: DataFrame, months: DataFrame, how: str) -> DataFrame:
    """Ledger rows inside or outside ``months``, at most one row a calendar month; null is a month too."""
    left, right = ledger.alias("l"), F.broadcast(months).alias("m")
    same = [F.col(f"l.{name}").eqNullSafe(F.col(f"m.{name}")) for name in MONTH]
    return left.join(right, same, how)


def refresh_months(
    transactions: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    ledger: DataFrame,
    root: str,
    name: str = "transactions",
) -> Refresh:
    """Replace the months that ``transactions`` has rows for; other months' files stay.

    ``ledger`` is a reader of the stored table ``name`` under ``root``. The input holds all rows
    of its months and is validated and enriched like a full load; rows without a date
    form a partition of their own. Dimension keys must be unique.

    The high-value cutoff is global: it is taken from the new rows and one column of the other
    months. If it moves, some rows of other months may change sides: only the months
    that have such rows are written again, with their flags restated. The result
    equals a full rebuild.
    """
    clean = settle(quality.validate(transactions), "refreshed")
    months = settle(with_date_features(clean).select(*MONTH).distinct(), "months")
    others = by_month(ledger, months, "left_anti")
    population = clean.select("revenue").unionByName(others.select("revenue"))
    cutoff = settle(quantile_cutoff(population, "revenue", HIGH_VALUE_FRACTION), "cutoff")

    flag = F.coalesce(F.col("revenue") >= cutoff.scalar(), F.lit(False))
    stale = settle(others.where(F.col("is_high_value") != flag).select(*MONTH).distinct(), "stale")
    # the flag of the new rows alone is never computed: the one below replaces it
    fresh = enrich(clean, customers, products, clean, gather_months).withColumn("is_high_value", flag)
    # stored by month already: a task that reads a file of one month writes one of that month
    restated = by_month(ledger, stale, "left_semi").withColumn("is_high_value", flag)
    changed = fresh.unionByName(restated)
    return Refresh(replace_partitions(changed, root, name, MONTH, is_gathered=True), months, stale)
