"""Time the headline queries and the whole batch job; print one JSON line.

BENCH_SF_DIR   folder of parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_REPEATS  timed runs per query after one warm-up; the median counts (default 5)
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable
from statistics import median

from pyspark.sql import SparkSession

from checks import registry
from tallyworks.plans import etl
from tallyworks.session import get_session, scratch_path
from tallyworks.sources import star

HEADLINES = [
    "validated_transactions",
    "enriched_ledger",
    "high_value_threshold",
    "monthly_summary",
    "category_summary",
    "region_summary",
    "channel_summary",
    "monthly_kpis",
    "top_products",
    "customer_rfm",
    "forecast_detail",
    "series_features_by_product",
    "moving_average_by_product",
]


def run_query(spark: SparkSession, folder: str, name: str) -> None:
    """Compute every row and column of the result without storing it."""
    registry.queries()[name](spark, folder).write.format("noop").mode("overwrite").save()


def run_job(spark: SparkSession, folder: str) -> None:
    """Validate, enrich, summarise, store seven tables, export five CSVs."""
    etl.run_etl(
        star.transactions(spark, folder),
        star.customers(spark, folder),
        star.products(spark, folder),
        scratch_path(spark, "job"),
    )


def typical(action: Callable[[], None], repeats: int) -> float:
    spent = []
    for _ in range(1 + repeats):
        started = time.perf_counter()
        action()
        spent.append(time.perf_counter() - started)
    return round(median(spent[1:]), 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeats = int(os.environ.get("BENCH_REPEATS", "5"))
    spark = get_session("bench", cores=int(os.environ.get("BENCH_CPUS", "8")), **{
        "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    timings = {
        name: typical(lambda name=name: run_query(spark, folder, name), repeats)
        for name in HEADLINES
    }
    timings["etl_end_to_end"] = typical(lambda: run_job(spark, folder), repeats)
    rows = star.read_table(spark, folder, "lineitem").count()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "transactions": rows,
                "etl_transactions_per_sec": round(rows / timings["etl_end_to_end"]),
            }
        )
    )


if __name__ == "__main__":
    main()
