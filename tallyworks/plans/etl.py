"""The batch job: validate, enrich, summarise, store, export, forecast."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyworks.operators import quality, series, summaries
from tallyworks.operators.enrich import enrich, with_month
from tallyworks.plans import forecast
from tallyworks.session import concurrently, scratch_below, settle
from tallyworks.sinks.tables import gathered, write_csv, write_table

SUMMARIES = {
    "monthly_summary": summaries.monthly_summary,
    "category_summary": summaries.category_summary,
    "region_summary": summaries.region_summary,
    "channel_summary": summaries.channel_summary,
}


def keys_are_unique(customers: DataFrame, products: DataFrame) -> bool:
    return (
        quality.duplicate_keys(customers, "customer_id").isEmpty()
        and quality.duplicate_keys(products, "product_id").isEmpty()
    )


def gather_months(rows: DataFrame) -> DataFrame:
    """Rows by month, sorted so while they are narrow: a write by month then sorts no whole rows."""
    return gathered(rows, summaries.MONTH).sortWithinPartitions(*summaries.MONTH)


def enriched_ledger(
    clean: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    gather: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Repeated dimension keys multiply rows, which then count for the cutoff as well."""
    population = clean if keys_are_unique(customers, products) else None
    return enrich(clean, customers, products, population, gather)


def collapse(transactions: DataFrame, together: Sequence[str] = ()) -> DataFrame:
    """The duplicate-free rows, settled: audit, cutoff and ledger all start there."""
    return settle(quality.collapse_duplicates(transactions, together), "collapsed")


def collapse_observed(
    transactions: DataFrame, together: Sequence[str] = ()
) -> tuple[DataFrame, dict[str, int]]:
    """The same, and what the audit counts of these rows, observed by the pass that writes them.

    Every task of the write counts its rows, so the copy is not read again to count them.
    """
    counted = Observation("collapsed")
    rows = quality.collapse_duplicates(transactions, together)
    columns = [c for c in transactions.columns if c not in together]
    copy = settle(rows.observe(counted, *quality.audit_metrics(columns)), "collapsed")
    return copy, counted.get


def collapse_narrow(
    rows: DataFrame,
    derive: Callable[[DataFrame], DataFrame],
    together: Sequence[str] = (),
    observed: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame, Callable[[], dict[str, int]]]:
    """The same for rows that ``derive`` adds the transactions' columns to, and these rows by month.

    The narrow rows are what is settled and what is gathered by month; the rest is derived on reading
    and after the gathering. Equal transactions must have equal ``rows``, which carry what the lookups
    find: the dimensions' keys must be unique. ``observed`` names the columns whose nulls the audit
    counts; without it nothing is counted.
    """
    counted = Observation("collapsed")
    narrow = quality.count_copies(rows, together)
    kept = narrow
    if observed:
        watched = quality.judged(derive(narrow)).observe(counted, *quality.audit_metrics(list(observed)))
        kept = watched.select(narrow.columns)
    copy = settle(kept, "collapsed")
    by_month = gather_months(with_month(copy))
    counts = lambda: counted.get if observed else {}
    return quality.judged(derive(copy)), quality.judged(derive(by_month)), counts


def table_writes(frames: dict[str, DataFrame], target: str) -> dict[str, Callable[[], DataFrame]]:
    return {name: partial(write_table, frame, target, name) for name, frame in frames.items()}


def store_tables(
    collapsed: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    target: str,
    by_month: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Write the seven tables and return readers of them.

    The summaries read the stored ledger. ``by_month`` may be the collapsed rows gathered by month,
    with what the lookups of unique keys find (``collapse_narrow``).
    """
    spark = collapsed.sparkSession
    clean = quality.accepted(collapsed)
    if by_month is None:
        ledger = enriched_ledger(clean, customers, products, gather_months)
    else:
        ledger = enrich(
            quality.accepted(by_month), customers, products, population=clean, has_month=True
        )
    writes = table_writes({"customers": customers, "products": products}, target)
    writes["transactions"] = partial(
        write_table, ledger, target, "transactions", summaries.MONTH, is_gathered=True
    )
    stored = concurrently(spark, writes)
    summary = {name: build(stored["transactions"]) for name, build in SUMMARIES.items()}
    return stored | concurrently(spark, table_writes(summary, target))


def lookup_misses(rows: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """(dimension, key, rows) of the customers and products that the lookups do not find."""
    return quality.unmatched_keys(rows, customers, "customer_id", "customers").unionByName(
        quality.unmatched_keys(rows, products, "product_id", "products")
    )


def observed_audit(spark: SparkSession, observed: dict[str, int]) -> DataFrame:
    """(stage, metric, value) of the rows loaded and removed, and of nulls where there are any."""
    counts = {name: n for name, n in observed.items() if not name.startswith("nulls ")}
    counts["removed"] = counts["loaded"] - counts["remaining"]
    nulls = {name.removeprefix("nulls "): n for name, n in observed.items() if name.startswith("nulls ")}
    rows = [("validate", metric, n) for metric, n in counts.items()]
    rows += [("nulls", column, n) for column, n in nulls.items() if n > 0]
    return spark.createDataFrame(rows, "stage string, metric string, value long")


def audit(
    collapsed: DataFrame, stored: dict[str, DataFrame], observed: dict[str, int] | None = None
) -> DataFrame:
    """(stage, metric, value): rows loaded, removed, stored and not matched, nulls per column.

    ``observed`` has the counts of the collapsed rows if the pass that wrote them took them.
    """
    tables = quality.table_counts(stored).select(
        F.lit("load").alias("stage"),
        F.col("table_name").alias("metric"),
        F.col("row_count").alias("value"),
    )
    missing = lookup_misses(stored["transactions"], stored["customers"], stored["products"])
    names = collapsed.sparkSession.createDataFrame([("customers",), ("products",)], "dimension string")
    unmatched = (
        names.join(missing, "dimension", "left")
        .groupBy("dimension")
        .agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("value"))
        .select(F.lit("unmatched").alias("stage"), F.col("dimension").alias("metric"), "value")
    )
    if observed is not None:
        checked = [observed_audit(collapsed.sparkSession, observed)]
    else:
        checked = counted_audit(collapsed)
    return reduce(DataFrame.unionByName, [*checked, tables, unmatched])


def counted_audit(collapsed: DataFrame) -> list[DataFrame]:
    counts = quality.validation_counts(collapsed)
    validated = counts.unpivot([], counts.columns, "metric", "value").select(
        F.lit("validate").alias("stage"), "metric", F.col("value").cast("long").alias("value")
    )
    nulls = quality.null_counts(collapsed).select(
        F.lit("nulls").alias("stage"),
        F.col("column_name").alias("metric"),
        F.col("nulls").alias("value"),
    )
    return [validated, nulls]


def csv_writes(stored: dict[str, DataFrame], target: str) -> dict[str, Callable[[], str]]:
    """The four summaries and the cleaned ledger as CSV folders."""
    exports = {name: stored[name] for name in SUMMARIES}
    exports["transactions_clean"] = stored["transactions"]
    return {name: partial(write_csv, frame, target, name) for name, frame in exports.items()}


def quarantine_tables(quarantine: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {f"quarantine_{name}": rows for name, rows in quarantine.items()}


def quarantine_counts(stored: dict[str, DataFrame]) -> DataFrame:
    return quality.table_counts(stored).select(
        F.lit("quarantine").alias("stage"),
        F.regexp_replace("table_name", "^quarantine_", "").alias("metric"),
        F.col("row_count").alias("value"),
    )


def run_etl(
    transactions: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    target: str,
    quarantine: dict[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Seven tables and the audit under ``target``/tables, exports under ``target``/csv.

    ``quarantine`` has the rows that the readers refused (``files.quarantines``):
    they are stored beside the tables and counted in the audit.
    """
    spark = transactions.sparkSession
    with scratch_below(spark, target):
        collapsed, observed = collapse_observed(transactions)
        stored = store_tables(collapsed, customers, products, f"{target}/tables")
        checked = audit(collapsed, stored, observed)
        if quarantine:
            kept = concurrently(spark, table_writes(quarantine_tables(quarantine), f"{target}/tables"))
            checked = checked.unionByName(quarantine_counts(kept))
            stored |= kept
        last = table_writes({"etl_audit": checked}, f"{target}/tables")
        done = concurrently(spark, last | csv_writes(stored, f"{target}/csv"))
    return stored | {"etl_audit": done["etl_audit"]}


def run_forecast(
    spark: SparkSession, target: str, window: int = 3, horizon: int = 6
) -> dict[str, DataFrame]:
    """Forecast from the stored monthly summary; write both exports and the metrics."""
    monthly = spark.read.parquet(f"{target}/tables/monthly_summary")
    history = series.total_series(monthly)
    with scratch_below(spark, target):
        models = settle(forecast.fit(history), "models")
        detail = write_table(
            forecast.forecast_detail(history, window, horizon, models),
            f"{target}/tables",
            "forecast_detail",
        )
        combined = forecast.actuals_and_forecast(history, detail).drop("series")
        write_csv(detail.drop("series").orderBy("period"), f"{target}/csv", "forecast_detail")
        write_csv(combined, f"{target}/csv", "revenue_actuals_vs_forecast")
        return {
            "forecast_detail": detail,
            "actuals_and_forecast": combined,
            "forecast_metrics": write_table(
                forecast.run_summary(models), f"{target}/tables", "forecast_metrics"
            ),
        }
