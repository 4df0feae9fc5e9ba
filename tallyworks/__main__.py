"""Run the job: ``python -m tallyworks SOURCE TARGET [--forecast-only]``.

SOURCE holds transactions, customers and products as CSV files or folders.
"""

from __future__ import annotations

import argparse

from tallyworks.plans import etl
from tallyworks.session import get_session
from tallyworks.sources import files


def main() -> None:
    parser = argparse.ArgumentParser(prog="tallyworks")
    parser.add_argument("source")
    parser.add_argument("target")
    parser.add_argument("--forecast-only", action="store_true")
    parser.add_argument("--horizon", type=int, default=6)
    parser.add_argument("--local-cores", type=int, help="run in this process on so many cores")
    options = parser.parse_args()
    spark = get_session(cores=options.local_cores)
    if not options.forecast_only:
        paths = [f"{options.source}/{name}.csv" for name in ("transactions", "customers", "products")]
        etl.run_etl(
            files.read_transactions(spark, paths[0]),
            files.read_customers(spark, paths[1]),
            files.read_products(spark, paths[2]),
            options.target,
            files.quarantines(spark, *paths),
        )
    etl.run_forecast(spark, options.target, horizon=options.horizon)
    spark.stop()


if __name__ == "__main__":
    main()
