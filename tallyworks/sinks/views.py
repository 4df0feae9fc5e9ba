"""Stored tables and the six report views over them, for use from SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tallyworks.operators import reports


def report_views(
    tables: dict[str, DataFrame], as_of: dt.date | None = None
) -> dict[str, DataFrame]:
    """View name to query, from the tables an ETL run stores."""
    return {
        "vw_monthly_kpis": reports.monthly_kpis(tables["monthly_summary"]),
        "vw_category_performance": reports.category_performance(tables["category_summary"]),
        "vw_regional_heatmap": reports.regional_heatmap(tables["region_summary"]),
        "vw_channel_campaign": reports.channel_campaign(tables["channel_summary"]),
        "vw_top_products": reports.top_products(tables["transactions"]),
        "vw_customer_rfm": reports.customer_rfm(tables["transactions"], as_of),
    }


def register_tables(tables: dict[str, DataFrame]) -> list[str]:
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    return list(tables)


def register_views(tables: dict[str, DataFrame], as_of: dt.date | None = None) -> list[str]:
    """Create or replace the tables and the report views in the session."""
    return register_tables(tables) + register_tables(report_views(tables, as_of))
