"""DuckDB SQL for the registered queries.

Written independently of the DataFrame code: money is integer cents throughout,
and least squares is solved by successive orthogonalisation.
"""

from __future__ import annotations

AS_OF = "2002-01-01"


def money(cents: str) -> str:
    return f"(({cents})::DOUBLE / 100::DOUBLE)"


def even(value: str, places: int = 2) -> str:
    """Round a double half-to-even after scaling."""
    scale = f"{10**places}::DOUBLE"
    return f"(round_even(({value}) * {scale}, 0) / {scale})"


def up_ratio(numerator: str, denominator: str) -> str:
    """numerator / denominator, integers, to two places half away from zero."""
    n, d = f"({numerator})::HUGEINT", f"({denominator})::HUGEINT"
    return (
        f"(CASE WHEN {d} = 0 THEN NULL ELSE "
        f"sign({n}) * ((200 * abs({n}) + {d}) // (2 * {d}))::DOUBLE / 100::DOUBLE END)"
    )


LINES = """
lines AS (
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS transaction_id,
         l_orderkey, l_partkey,
         o_orderdate::DATE AS date,
         year(o_orderdate)::INTEGER AS year,
         month(o_orderdate)::INTEGER AS month,
         strftime(o_orderdate, '%Y-%m') AS period,
         o_custkey AS customer_id,
         l_partkey AS product_id,
         l_linestatus AS channel,
         nullif(o_orderpriority, '4-NOT SPECIFIED') AS campaign,
         l_quantity::INTEGER AS quantity,
         round(l_extendedprice * 100)::BIGINT AS gross_c,
         round(abs(l_discount) * 100)::INTEGER AS discount_pct,
         (gross_c * discount_pct + 50) // 100 AS discount_c,
         gross_c - discount_c AS revenue_c,
         l_returnflag = 'R' AS is_returned,
         CASE l_returnflag WHEN 'R' THEN 'Returned' WHEN 'A' THEN 'Pending'
              ELSE 'Completed' END AS status
  FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey
),
people AS (
  SELECT c_custkey AS customer_id, c_name AS name, n_name AS city, r_name AS region,
         c_mktsegment AS segment
  FROM customer
  LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN region ON r_regionkey = n_regionkey
),
goods AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         round(p_retailprice * 100)::BIGINT AS price_c
  FROM part
)"""

UNFORESEEN = LINES.replace(
    "c_mktsegment AS segment",
    "CASE WHEN c_custkey % 10 = 0 THEN 'UNFORESEEN' ELSE c_mktsegment END AS segment",
)

LEDGER = (
    LINES
    + f""",
priced AS (
  SELECT l.*, region, segment, city, category, price_c,
         price_c * quantity AS cost_c,
         revenue_c - cost_c AS profit_c,
         CASE WHEN revenue_c > 0
              THEN {even(f"{money('profit_c')} / {money('revenue_c')} * 100::DOUBLE")}
              ELSE 0::DOUBLE END AS margin
  FROM lines l
  LEFT JOIN people USING (customer_id)
  LEFT JOIN goods USING (product_id)
),
cut AS (
  SELECT quantile_cont(revenue_c::DOUBLE, 0.9) AS threshold_c FROM lines
),
ledger AS (
  SELECT priced.*, coalesce(revenue_c >= (SELECT threshold_c FROM cut), false) AS is_high_value
  FROM priced
),
kept AS (SELECT * FROM ledger WHERE NOT is_returned)"""
)

MONTHLY = (
    LEDGER
    + f""",
monthly AS (
  SELECT year, month, strftime(min(date), '%b') AS month_name,
         quarter(min(date))::INTEGER AS quarter,
         sum(revenue_c) AS revenue_c, sum(profit_c) AS profit_c, sum(cost_c) AS cost_c,
         count(transaction_id) AS total_orders,
         sum(quantity)::BIGINT AS total_units,
         {even(f"{money('sum(revenue_c)')} / count(revenue_c)")} AS avg_order_value,
         round_even(sum(round_even(margin * 100, 0)::BIGINT)::DOUBLE / count(margin), 0)
           / 100::DOUBLE AS avg_margin_pct,
         count(DISTINCT customer_id) AS unique_customers,
         count(*) FILTER (is_high_value) AS high_value_orders,
         count(*) FILTER (is_returned) AS returns,
         period
  FROM kept WHERE date IS NOT NULL GROUP BY year, month, period
)"""
)

CATEGORY = (
    LEDGER
    + """,
by_category AS (
  SELECT year, month, category, sum(revenue_c) AS revenue_c, sum(profit_c) AS profit_c,
         count(*) AS orders, sum(quantity)::BIGINT AS units
  FROM kept WHERE category IS NOT NULL AND date IS NOT NULL GROUP BY year, month, category
)"""
)

REGION = (
    LEDGER
    + """,
by_region AS (
  SELECT year, month, region, segment, sum(revenue_c) AS revenue_c, sum(profit_c) AS profit_c,
         count(*) AS orders, count(DISTINCT customer_id) AS customers
  FROM kept WHERE region IS NOT NULL AND segment IS NOT NULL AND date IS NOT NULL
  GROUP BY year, month, region, segment
)"""
)

CHANNEL = (
    LEDGER
    + f""",
by_channel AS (
  SELECT year, month, channel, campaign, sum(revenue_c) AS revenue_c, count(*) AS orders,
         {even("sum(discount_pct)::DOUBLE / count(discount_pct)")} AS avg_discount,
         sum(discount_c) AS discount_c
  FROM kept WHERE channel IS NOT NULL AND campaign IS NOT NULL AND date IS NOT NULL
  GROUP BY year, month, channel, campaign
)"""
)

KEPT = "kept AS (SELECT * FROM ledger WHERE NOT is_returned)"
# Every seventh product's sales have no status: the views drop them, the summaries keep them.
KEPT_LINES = "sold AS (SELECT * FROM lines WHERE NOT is_returned)"

KNOWN_STATUS = "kept AS (SELECT * FROM ledger WHERE NOT is_returned AND product_id % 7 <> 0)"
UNKNOWN_STATUS = "kept AS (SELECT * FROM ledger WHERE NOT is_returned OR product_id % 7 = 0)"

PRODUCT_TOTALS = (
    LEDGER
    + f""",
by_product AS (
  SELECT product_id, category, count(*) AS total_orders,
         sum(quantity)::BIGINT AS total_units_sold,
         {money("sum(revenue_c)")} AS total_revenue,
         {money("sum(profit_c)")} AS total_profit,
         {up_ratio("sum(round_even(margin * 100, 0)::BIGINT)", "100 * count(margin)")}
           AS avg_margin_pct,
         count(*) FILTER (is_returned) AS total_returns
  FROM kept GROUP BY product_id, category
)"""
)

# Crafted faults on top of every line: repeated rows, negative revenue, zero
# quantity, missing revenue and campaign. The moduli only place the faults.
DIRTY = (
    LINES
    + f""",
dirty AS (
  SELECT transaction_id, date, customer_id, product_id, channel, gross_c, discount_c, is_returned, unit_price,
         CASE WHEN l_orderkey % 17 <> 0 THEN campaign END AS campaign,
         CASE WHEN l_partkey % 13 = 0 THEN 0 ELSE quantity END AS quantity,
         discount_pct,
         CASE WHEN l_partkey % 17 = 0 THEN NULL
              WHEN l_partkey % 11 = 0 THEN -revenue_c ELSE revenue_c END AS revenue_c,
         status
  FROM (SELECT *, {even(f"{money('gross_c')} / quantity")} AS unit_price
        FROM (SELECT * FROM lines UNION ALL SELECT * FROM lines WHERE l_orderkey % 7 = 0))
),
spotless AS (SELECT DISTINCT * FROM dirty),
judged AS (
  SELECT *, CASE WHEN revenue_c < 0 THEN 'negative_revenue'
                 WHEN quantity <= 0 THEN 'non_positive_quantity' END AS fault
  FROM spotless
)"""
)
DIRTY_COLUMNS = (
    "transaction_id, date, customer_id, product_id, channel, campaign, quantity, discount_pct, "
    f"{money('revenue_c')} AS revenue, status, is_returned, "
    f"{money('discount_c')} AS discount_amount, unit_price"
)


def series_of(name: str, source: str = "lines", where: str = "NOT is_returned") -> str:
    """CTE ``series``: monthly revenue per ``name`` (an SQL expression)."""
    return f"""
series AS (
  SELECT {name} AS series, period, min(year)::INTEGER AS year, min(month)::INTEGER AS month,
         quarter(min(date))::INTEGER AS quarter, sum(revenue_c) AS revenue_c
  FROM {source} WHERE {where} AND date IS NOT NULL AND ({name}) IS NOT NULL
  GROUP BY {name}, period
)"""


def trailing(width: int) -> str:
    over = f"OVER (PARTITION BY series ORDER BY period ROWS {width - 1} PRECEDING)"
    return f"{money(f'sum(revenue_c) {over}')} / count(revenue_c) {over}"


FEATURES = f"""
features AS (
  SELECT series, period, year, month, quarter, revenue_c,
         (row_number() OVER (PARTITION BY series ORDER BY period) - 1)::INTEGER AS t,
         {trailing(3)} AS ma_3,
         {trailing(6)} AS ma_6,
         {money("lag(revenue_c, 1) OVER (PARTITION BY series ORDER BY period)")} AS lag_1,
         {money("lag(revenue_c, 3) OVER (PARTITION BY series ORDER BY period)")} AS lag_3,
         sin(2::DOUBLE * pi() * month / 12::DOUBLE) AS sin_month,
         cos(2::DOUBLE * pi() * month / 12::DOUBLE) AS cos_month,
         quarter AS quarter_enc
  FROM series
),
split AS (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY period) - 1
              < floor(count(*) OVER (PARTITION BY series) * 0.8::DOUBLE) AS is_train
  FROM features WHERE lag_3 IS NOT NULL
)"""

MODEL_COLUMNS = ["t", "sin_month", "cos_month", "quarter_enc", "ma_3", "lag_1"]

SCALING = "\nUNION ALL\n".join(
    f"SELECT series, '{c}' AS feature, avg({c}::DOUBLE) AS mean, "
    f"CASE WHEN stddev_pop({c}::DOUBLE) = 0 THEN 1 ELSE stddev_pop({c}::DOUBLE) END AS scale "
    f"FROM split WHERE is_train GROUP BY series"
    for c in MODEL_COLUMNS
)

MOVING_AVERAGE = f"""
walk AS (
  WITH RECURSIVE steps AS (
    SELECT series, max(period) AS last_period, 0 AS step,
           list({money("revenue_c")} ORDER BY period) AS history
    FROM series GROUP BY series
    UNION ALL
    SELECT series, last_period, step + 1,
           list_append(history, list_sum(history[-3:]) / len(history[-3:]))
    FROM steps WHERE step < 6
  )
  SELECT series, step,
         strftime(strptime(last_period || '-01', '%Y-%m-%d') + to_months(step), '%Y-%m') AS period,
         {even("history[-1]")} AS ma_forecast
  FROM steps WHERE step > 0
)"""

FUTURE = f"""
future AS (
  SELECT s.series, step::INTEGER AS step, f.t AS last_t,
         strftime(coming, '%Y-%m') AS period,
         month(coming)::INTEGER AS month, quarter(coming)::INTEGER AS quarter,
         (f.t + step)::INTEGER AS t,
         sin(2::DOUBLE * pi() * month(coming) / 12::DOUBLE) AS sin_month,
         cos(2::DOUBLE * pi() * month(coming) / 12::DOUBLE) AS cos_month,
         quarter(coming)::INTEGER AS quarter_enc,
         f.ma_3, {money("f.revenue_c")} AS lag_1
  FROM (SELECT series, max(period) AS last_period FROM split GROUP BY series) s
  JOIN features f ON f.series = s.series AND f.period = s.last_period
  CROSS JOIN range(1, 7) steps(step)
  CROSS JOIN LATERAL (
    SELECT strptime(s.last_period || '-01', '%Y-%m-%d') + to_months(step::INTEGER) AS coming)
)"""


def _least_squares() -> str:
    """CTEs ``fit_0`` … ``fit_n``: regress on one orthogonalised column at a time."""
    columns = MODEL_COLUMNS
    picked = ", ".join(f"{c}::DOUBLE AS {c}" for c in columns)
    ctes = [
        f"""
stacked AS (
  SELECT series, period, 0 AS step, is_train, {picked}, {money("revenue_c")} AS y FROM split
  UNION ALL
  SELECT series, period, step, false, {picked}, NULL FROM future
)"""
    ]

    def trained(expression: str, how: str) -> str:
        return f"{how}(CASE WHEN is_train THEN {expression} END) OVER (PARTITION BY series)"

    scaled = ", ".join(
        f"({c} - {trained(c, 'avg')}) / "
        f"coalesce(nullif({trained(c, 'stddev_pop')}, 0), 1) AS {c}"
        for c in columns
    )
    ctes.append(
        f"fit_0 AS (SELECT series, period, step, is_train, y, {scaled}, "
        f"{trained('y', 'avg')} AS guess, y - {trained('y', 'avg')} AS rest FROM stacked)"
    )
    for i, c in enumerate(columns):
        norm = f"nullif({trained(f'{c} * {c}', 'sum')}, 0)"
        slope = f"coalesce({trained(f'rest * {c}', 'sum')} / {norm}, 0)"
        later = [
            f"{d} - coalesce({trained(f'{d} * {c}', 'sum')} / {norm}, 0) * {c} AS {d}"
            for d in columns[i + 1 :]
        ]
        kept = ["series", "period", "step", "is_train", "y", *later]
        kept += [f"guess + {slope} * {c} AS guess", f"rest - {slope} * {c} AS rest"]
        ctes.append(f"fit_{i + 1} AS (SELECT {', '.join(kept)} FROM fit_{i})")
    return ",\n".join(ctes)


def _shortest_least_squares(dependent: str = "1e-16::DOUBLE") -> str:
    """CTEs ending in ``solved``: the shortest least squares solution, also of dependent columns.

    Every series gets one extra row a column, with a one there: the steps that orthogonalise the
    columns leave in these rows what each is made of, and the solution. Columns that leave
    nothing of themselves name the directions in which the solution may move freely;
    it is freed of all of them.
    """
    columns = MODEL_COLUMNS
    size = len(columns)
    real = ", ".join(f"{c}::DOUBLE AS {c}" for c in columns)
    unit = ", ".join(f"CASE WHEN unit = {i} THEN 1::DOUBLE ELSE 0::DOUBLE END AS {c}" for i, c in enumerate(columns))

    def over(rows: str, expression: str, how: str = "sum") -> str:
        return f"{how}(CASE WHEN {rows} THEN {expression} END) OVER (PARTITION BY series)"

    scales = {c: (over("is_train", c, "avg"), over("is_train", c, "stddev_pop")) for c in columns}
    scaled = ", ".join(
        f"({c} - {mean}) / coalesce(nullif({deviation}, 0), 1) AS {c}" for c, (mean, deviation) in scales.items()
    )
    ctes = [
        f"""stacked AS (
  SELECT series, period, 0 AS step, is_train, {real}, {money("revenue_c")} AS y FROM split
  UNION ALL
  SELECT series, period, step, false, {real}, NULL FROM future
)""",
        f"""scaled AS (
  SELECT series, period, step, is_train, y, {scaled}, {over("is_train", "y", "avg")} AS level FROM stacked)""",
        f"""fit_0 AS (
  SELECT series, period, step, -1 AS unit, is_train, y - level AS rest, 0::DOUBLE AS w,
         {", ".join(columns)} FROM scaled WHERE is_train
  UNION ALL
  SELECT series, NULL, NULL, unit, false, NULL, 0::DOUBLE, {unit}
  FROM (SELECT DISTINCT series FROM scaled WHERE is_train), range({size}) AS units(unit))""",
    ]
    for i, c in enumerate(columns):
        norm = over("is_train", f"{c} * {c}")
        left = f"{norm} / {over('is_train', '1', 'count')} <= {dependent}"
        names = ["series", "period", "step", "unit", "is_train"]
        ctes.append(
            f"share_{i} AS (SELECT *, CASE WHEN {left} THEN NULL ELSE {norm} END AS norm FROM fit_{i})"
        )
        kept = [*names, *(f"{columns[j]}" for j in range(i)), *(f"loose_{j}" for j in range(i))]
        kept += [c, f"norm IS NULL AS loose_{i}"]
        kept += [
            f"{d} - coalesce({over('is_train', f'{d} * {c}')} / norm, 0) * {c} AS {d}" for d in columns[i + 1 :]
        ]
        slope = f"coalesce({over('is_train', f'rest * {c}')} / norm, 0)"
        kept += [f"rest - {slope} * {c} AS rest", f"w + {slope} * {c} AS w"]
        ctes.append(f"fit_{i + 1} AS (SELECT {', '.join(kept)} FROM share_{i})")
    loose = ", ".join(f"CASE WHEN loose_{i} THEN {c} ELSE 0::DOUBLE END AS {c}" for i, c in enumerate(columns))
    ctes.append(f"free_0 AS (SELECT series, unit, w, {loose} FROM fit_{size} WHERE unit >= 0)")
    for i, c in enumerate(columns):
        norm = f"nullif(sum({c} * {c}) OVER (PARTITION BY series), 0)"
        later = [
            f"{d} - coalesce(sum({d} * {c}) OVER (PARTITION BY series) / {norm}, 0) * {c} AS {d}"
            for d in columns[i + 1 :]
        ]
        moved = f"w - coalesce(sum(w * {c}) OVER (PARTITION BY series) / {norm}, 0) * {c} AS w"
        ctes.append(f"free_{i + 1} AS (SELECT {', '.join(['series', 'unit', moved, *later])} FROM free_{i})")
    slopes = ", ".join(f"sum(w) FILTER (unit = {i}) AS w_{i}" for i in range(size))
    guess = " + ".join(f"{c} * w_{i}" for i, c in enumerate(columns))
    ctes.append(f"slopes AS (SELECT series, {slopes} FROM free_{size} GROUP BY series)")
    ctes.append(
        f"solved AS (SELECT series, period, step, is_train, y, level + {guess} AS guess FROM scaled JOIN slopes USING (series))"
    )
    return ",\n".join(ctes)


FITTED = f"{_least_squares()},\nsolved AS (SELECT * FROM fit_{len(MODEL_COLUMNS)}),\n"

REGRESSION = (
    f"{FUTURE},\n{FITTED}"
    + """
held AS (SELECT series, period, y AS actual, guess AS predicted FROM solved
         WHERE step = 0 AND NOT is_train),
metrics AS (
  SELECT series, count(*) AS test_rows, avg(abs(actual - predicted)) AS mae,
         sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse,
         CASE WHEN count(*) >= 2 THEN
           1 - sum((actual - predicted) * (actual - predicted)) / (var_pop(actual) * count(*)) END
           AS r2,
         avg(abs((actual - predicted) / nullif(actual, 0))) * 100 AS mape
  FROM held GROUP BY series
),"""
    + f"""
regressed AS (SELECT series, step, period, {even("greatest(guess, 0)")} AS lr_forecast
              FROM solved WHERE step > 0)"""
)

SHORTEST = REGRESSION.replace(FITTED, _shortest_least_squares() + ",\n").replace(
    "1 - sum((actual - predicted) * (actual - predicted)) / (var_pop(actual) * count(*)) END",
    """CASE WHEN var_pop(actual) > 0
           THEN 1 - sum((actual - predicted) * (actual - predicted)) / (var_pop(actual) * count(*))
           WHEN sum((actual - predicted) * (actual - predicted)) = 0 THEN 1 ELSE 0 END END""",
)

DETAIL = (
    f"{MOVING_AVERAGE},\n{REGRESSION},\n"
    + f"""
detail AS (
  SELECT series, walk.period, 'Forecast' AS type, ma_forecast AS ma_3_forecast, lr_forecast,
         CASE WHEN lr_forecast IS NULL THEN ma_forecast ELSE
           {even(
               "(CASE WHEN r2 > 0.8 THEN 0.65::DOUBLE ELSE 0.5::DOUBLE END) * lr_forecast + "
               "(1::DOUBLE - (CASE WHEN r2 > 0.8 THEN 0.65::DOUBLE ELSE 0.5::DOUBLE END))"
               " * ma_forecast"
           )} END AS ensemble_forecast
  FROM walk LEFT JOIN regressed USING (series, step) LEFT JOIN metrics USING (series)
)"""
)

SHORTEST_DETAIL = DETAIL.replace(REGRESSION, SHORTEST)

METRICS_OUT = (
    "test_rows, "
    f"{even('mae', 4)} AS mae, {even('rmse', 4)} AS rmse, {even('r2', 8)} AS r2, "
    f"{even('mape', 6)} AS mape, {even('100 - mape', 6)} AS accuracy"
)

TOTAL = series_of("'total'")
BY_CHANNEL = series_of("channel || '/' || campaign")
BY_CATEGORY = series_of("category", "kept")
BY_PRODUCT = series_of("product_id::VARCHAR")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(cte.strip().rstrip(",") for cte in ctes)


MONTHLY_OUT = f"""
SELECT year, month, month_name, quarter, {money("revenue_c")} AS total_revenue,
       {money("profit_c")} AS total_profit, {money("cost_c")} AS total_cost, total_orders,
       total_units, avg_order_value, avg_margin_pct, unique_customers, high_value_orders,
       returns, {even("returns::DOUBLE / total_orders * 100")} AS return_rate_pct, period
FROM monthly"""

KPIS_OUT = f"""
SELECT year, month, month_name, quarter, period, {money("revenue_c")} AS total_revenue,
       {money("profit_c")} AS total_profit, {money("cost_c")} AS total_cost, total_orders,
       total_units, avg_order_value, avg_margin_pct AS gross_margin_pct, unique_customers,
       high_value_orders, {even("returns::DOUBLE / total_orders * 100")} AS return_rate_pct,
       {up_ratio("100 * (revenue_c - lag(revenue_c) OVER (ORDER BY period))",
                 "lag(revenue_c) OVER (ORDER BY period)")} AS mom_revenue_growth_pct
FROM monthly"""

CATEGORY_OUT = f"""
SELECT year, month, category, {money("revenue_c")} AS revenue, {money("profit_c")} AS profit,
       orders, units FROM by_category"""

REGION_OUT = f"""
SELECT year, month, region, segment, {money("revenue_c")} AS revenue,
       {money("profit_c")} AS profit, orders, customers FROM by_region"""

CHANNEL_OUT = f"""
SELECT year, month, channel, campaign, {money("revenue_c")} AS revenue, orders, avg_discount,
       {money("discount_c")} AS total_discount FROM by_channel"""

DATE_FEATURES = """year(date)::INTEGER AS year, month(date)::INTEGER AS month,
       strftime(date, '%b') AS month_name, quarter(date)::INTEGER AS quarter,
       weekofyear(date)::INTEGER AS week, dayname(date) AS day_name,
       isodow(date) >= 6 AS is_weekend"""

RAW_MONEY = f"""{even(f"{money('gross_c')} / quantity")} AS unit_price, discount_pct,
       {money("discount_c")} AS discount_amount, {money("revenue_c")} AS revenue"""

LEDGER_OUT = f"""
SELECT transaction_id, date, customer_id, product_id, channel, campaign, quantity, {RAW_MONEY},
       {money("cost_c")} AS cost, {money("profit_c")} AS profit, is_returned, status,
       {DATE_FEATURES}, region, segment, city, category, {money("price_c")} AS cost_price,
       margin AS gross_margin_pct,
       {even(f"{money('revenue_c')} / nullif(quantity, 0)")} AS revenue_per_unit, is_high_value
FROM ledger"""

FEATURES_OUT = f"""
SELECT series, period, year, month, quarter, {money("revenue_c")} AS revenue, t, ma_3, ma_6,
       lag_1, lag_3, sin_month, cos_month, quarter_enc"""

RFM_OUT = f"""
SELECT customer_id, region, segment, count(*) AS frequency, {money("sum(revenue_c)")} AS monetary,
       {up_ratio("sum(revenue_c)", "100 * count(revenue_c)")} AS avg_order_value,
       max(date) AS last_purchase_date, (DATE '{AS_OF}' - max(date))::INTEGER AS recency_days
FROM kept GROUP BY customer_id, region, segment"""

TABLE_COUNTS = """
SELECT 'transactions' AS table_name, (SELECT count(*) FROM ledger) AS row_count
UNION ALL SELECT 'customers', (SELECT count(*) FROM people)
UNION ALL SELECT 'products', (SELECT count(*) FROM goods)"""

SUMMARY_COUNTS = """
UNION ALL SELECT 'monthly_summary', count(*) FROM (
  SELECT DISTINCT year, month FROM kept WHERE date IS NOT NULL)
UNION ALL SELECT 'category_summary', count(*) FROM (
  SELECT DISTINCT year, month, category FROM kept WHERE date IS NOT NULL AND category IS NOT NULL)
UNION ALL SELECT 'region_summary', count(*) FROM (
  SELECT DISTINCT year, month, region, segment FROM kept
  WHERE date IS NOT NULL AND region IS NOT NULL AND segment IS NOT NULL)
UNION ALL SELECT 'channel_summary', count(*) FROM (
  SELECT DISTINCT year, month, channel, campaign FROM kept
  WHERE date IS NOT NULL AND campaign IS NOT NULL)"""


# Queries that store a result and read it back, by the query whose rows they must return.
STORED = {
    "exported_monthly_summary": "monthly_summary",
    "exported_category_summary": "category_summary",
    "exported_region_summary": "region_summary",
    "exported_channel_summary": "channel_summary",
    "exported_ledger": "enriched_ledger",
    "refreshed_ledger": "enriched_ledger",
    "ledger_by_calendar": "ledger_of_a_quarter",
    "exported_forecast_detail": "forecast_detail",
    "exported_actuals_and_forecast": "actuals_and_forecast",
    "monthly_kpis_view": "monthly_kpis",
    "category_performance_view": "category_performance",
    "regional_heatmap_view": "regional_heatmap",
    "channel_campaign_view": "channel_campaign",
    "top_products_view": "top_products",
    "customer_rfm_view": "customer_rfm",
}


# Summaries whose dimensions hold every tenth key twice: the joins repeat rows.
REPEATED = [
    "monthly_summary",
    "category_summary",
    "region_summary",
    "channel_summary",
    "top_products",
    "customer_rfm",
]


def with_repeated_keys(sql: str) -> str:
    return (
        sql.replace("LEFT JOIN people USING", "LEFT JOIN twice_people USING")
        .replace("LEFT JOIN goods USING", "LEFT JOIN twice_goods USING")
        # the cutoff is taken from the joined rows
        .replace("AS threshold_c FROM lines", "AS threshold_c FROM priced")
        .replace(
            "\npriced AS (",
            """
twice_people AS (FROM people UNION ALL FROM people WHERE customer_id % 10 = 0),
twice_goods AS (FROM goods UNION ALL FROM goods WHERE product_id % 10 = 0),
priced AS (""",
            1,
        )
    )


def oracle_sql() -> dict[str, str]:
    computed = computed_sql()
    stored = {name: computed[origin] for name, origin in STORED.items()}
    repeated = {f"{name}_repeated_keys": with_repeated_keys(computed[name]) for name in REPEATED}
    return computed | stored | repeated


def computed_sql() -> dict[str, str]:
    return {
        # sources and projections
        "transactions": f"""{with_(LINES)}
SELECT transaction_id, date, customer_id, product_id, channel, campaign, quantity, {RAW_MONEY},
       is_returned, status FROM lines""",
        "quarantined_transactions": f"""{with_(LINES)}
SELECT transaction_id,
       concat_ws(',', CASE WHEN product_id % 19 = 0 THEN 'quantity' END,
                 CASE WHEN product_id % 11 = 0 OR product_id % 13 = 0 THEN 'revenue' END)
         AS fault_columns,
       CASE WHEN fault_columns = '' THEN date END AS date
FROM lines""",
        "transactions_from_csv": f"""{with_(LEDGER)}
SELECT transaction_id, date, customer_id::VARCHAR AS customer_id,
       product_id::VARCHAR AS product_id, channel, campaign, quantity, {RAW_MONEY},
       {money("cost_c")} AS cost, {money("profit_c")} AS profit, is_returned, status
FROM ledger""",
        "customers": f"""{with_(LINES)} SELECT customer_id, name, city, region, segment
FROM people""",
        "customers_from_csv": f"""{with_(LINES)}
SELECT customer_id::VARCHAR AS customer_id, name, city, region, segment,
       NULL::DATE AS join_date, NULL::VARCHAR AS email FROM people""",
        "products": f"""{with_(LINES)}
SELECT product_id, product_name, category, {money("price_c")} AS unit_price,
       {money("price_c")} AS cost_price FROM goods""",
        "products_from_permuted_csv": f"""{with_(LINES)}
SELECT product_id::VARCHAR AS product_id,
       CASE WHEN product_id % 3 = 0 THEN replace(product_name, ' ', chr(10)) ELSE product_name END
         AS product_name,
       category, {money("price_c")} AS unit_price, {money("price_c")} AS cost_price,
       NULL::DOUBLE AS return_rate FROM goods""",
        "products_from_csv": f"""{with_(LINES)}
SELECT product_id::VARCHAR AS product_id, product_name, category,
       {money("price_c")} AS unit_price, {money("price_c")} AS cost_price,
       NULL::DOUBLE AS return_rate FROM goods""",
        "source_row_counts": f"""{with_(LEDGER)} {TABLE_COUNTS}""",
        "campaign_null_tokens": f"""{with_(LINES)}
SELECT campaign, count(*) AS orders FROM lines GROUP BY campaign""",
        "business_keys": """
SELECT 'customer' AS kind, c_custkey AS number,
       'CUST' || lpad(c_custkey::VARCHAR, greatest(5, len(c_custkey::VARCHAR))::INTEGER, '0') AS business_key
FROM customer
UNION ALL SELECT 'product', p_partkey,
       'PROD' || lpad(p_partkey::VARCHAR, greatest(4, len(p_partkey::VARCHAR))::INTEGER, '0') FROM part
UNION ALL SELECT 'transaction', o_orderkey,
       'TXN' || lpad(o_orderkey::VARCHAR, greatest(7, len(o_orderkey::VARCHAR))::INTEGER, '0') FROM orders""",
        "date_features": f"""{with_(LINES)}
SELECT transaction_id, date, {DATE_FEATURES}, period FROM lines""",
        "customer_lookup": f"""{with_(LINES)}
SELECT transaction_id, customer_id, region, segment, city
FROM lines LEFT JOIN people USING (customer_id)""",
        "customer_lookup_bucketed": f"""{with_(LINES)}
SELECT transaction_id, customer_id, region, segment, city
FROM lines LEFT JOIN people USING (customer_id)""",
        "unmatched_keys": f"""{with_(LINES)}
SELECT 'customers' AS dimension, customer_id::VARCHAR AS key, count(*) AS rows FROM lines
WHERE customer_id NOT IN (SELECT customer_id FROM people WHERE customer_id % 10 <> 0) GROUP BY customer_id
UNION ALL
SELECT 'products', product_id::VARCHAR, count(*) FROM lines
WHERE product_id NOT IN (SELECT product_id FROM goods WHERE product_id % 7 <> 0) GROUP BY product_id""",
        "product_lookup_with_misses": f"""{with_(LINES)}
SELECT transaction_id, product_id, category, {money("price_c")} AS cost_price
FROM lines LEFT JOIN (SELECT * FROM goods WHERE product_id % 10 <> 0) USING (product_id)""",
        "product_lookup_salted": f"""{with_(LINES)}
SELECT transaction_id, product_id, category, {money("price_c")} AS cost_price
FROM lines LEFT JOIN goods USING (product_id)""",
        "customer_lookup_salted": f"""{with_(LINES)}
SELECT transaction_id, customer_id, region, segment, city
FROM lines LEFT JOIN people USING (customer_id)""",
        "order_lookup_salted": f"""{with_(LINES)}
SELECT transaction_id, date, customer_id, product_id, channel, campaign, quantity, {RAW_MONEY},
       is_returned, status FROM lines""",
        "enriched_ledger": f"{with_(LEDGER)} {LEDGER_OUT}",
        "high_value_threshold": f"""{with_(LINES)}
SELECT {even(money("quantile_cont(revenue_c::DOUBLE, 0.9)"), 6)} AS threshold FROM lines""",
        # validation
        "null_counts": f"""{with_(DIRTY)}
SELECT 'campaign' AS column_name, count(*) FILTER (campaign IS NULL) AS nulls FROM dirty
UNION ALL SELECT 'revenue', count(*) FILTER (revenue_c IS NULL) FROM dirty""",
        "distinct_transactions": f"{with_(DIRTY)} SELECT {DIRTY_COLUMNS} FROM spotless",
        "non_negative_revenue": f"""{with_(DIRTY)}
SELECT {DIRTY_COLUMNS} FROM dirty WHERE revenue_c >= 0 OR revenue_c IS NULL""",
        "positive_quantity": f"{with_(DIRTY)} SELECT {DIRTY_COLUMNS} FROM dirty WHERE quantity > 0",
        "validated_transactions": f"""{with_(DIRTY)}
SELECT {DIRTY_COLUMNS} FROM judged WHERE fault IS NULL""",
        "validation_counts": f"""{with_(DIRTY)}
SELECT loaded, loaded - count(*) AS duplicates,
       count(*) FILTER (fault = 'negative_revenue') AS negative_revenue,
       count(*) FILTER (fault = 'non_positive_quantity') AS non_positive_quantity,
       count(*) FILTER (fault IS NULL) AS remaining, loaded - remaining AS removed
FROM judged, (SELECT count(*) AS loaded FROM dirty) GROUP BY loaded""",
        "observed_validation": f"""{with_(DIRTY)},
counted AS (
  SELECT loaded, loaded - count(*) AS duplicates,
         count(*) FILTER (fault = 'negative_revenue') AS negative_revenue,
         count(*) FILTER (fault = 'non_positive_quantity') AS non_positive_quantity,
         count(*) FILTER (fault IS NULL) AS remaining, loaded - remaining AS removed
  FROM judged, (SELECT count(*) AS loaded FROM dirty) GROUP BY loaded)
SELECT 'validate' AS stage, metric, value
FROM (UNPIVOT counted ON COLUMNS(*) INTO NAME metric VALUE value)
UNION ALL SELECT 'nulls', 'campaign', count(*) FILTER (campaign IS NULL) FROM dirty
UNION ALL SELECT 'nulls', 'revenue', count(*) FILTER (revenue_c IS NULL) FROM dirty""",
        "duplicate_keys": """
SELECT c_nationkey, count(*) AS copies FROM customer
GROUP BY c_nationkey HAVING count(*) > 1""",
        # summaries
        "monthly_summary": f"{with_(MONTHLY)} {MONTHLY_OUT}",
        "monthly_return_rates": f"""{with_(LINES)}
SELECT year, month, count(*) AS all_orders, count(*) FILTER (is_returned) AS returned_orders,
       {even("returned_orders::DOUBLE / all_orders * 100")} AS return_rate_all_pct, period
FROM lines WHERE date IS NOT NULL GROUP BY year, month, period""",
        "category_summary": f"{with_(CATEGORY)} {CATEGORY_OUT}",
        "region_summary": f"{with_(REGION)} {REGION_OUT}",
        "channel_summary": f"{with_(CHANNEL)} {CHANNEL_OUT}",
        "kpi_totals": f"""{with_(LEDGER)}
SELECT {money("sum(revenue_c)")} AS total_revenue, {money("sum(profit_c)")} AS total_profit,
       {even(f"{money('sum(revenue_c)')} / count(revenue_c)")} AS avg_order_value,
       {even(f"{money('sum(profit_c)')} / {money('sum(revenue_c)')} * 100")} AS gross_margin_pct
FROM kept""",
        # views and dashboard queries
        "monthly_kpis": f"{with_(MONTHLY)} {KPIS_OUT}",
        "category_performance": f"""{with_(CATEGORY)}
SELECT year, month, category, {money("revenue_c")} AS revenue, {money("profit_c")} AS profit,
       orders, units, {up_ratio("100 * profit_c", "revenue_c")} AS margin_pct FROM by_category""",
        "regional_heatmap": f"""{with_(REGION)}
SELECT year, month, region, segment, {money("revenue_c")} AS revenue,
       {money("profit_c")} AS profit, orders, customers,
       {up_ratio("revenue_c", "100 * customers")} AS revenue_per_customer FROM by_region""",
        "channel_campaign": f"""{with_(CHANNEL)}
SELECT year, month, channel, campaign, {money("revenue_c")} AS revenue, orders,
       avg_discount AS avg_discount_pct, {money("discount_c")} AS total_discount_given,
       {up_ratio("revenue_c", "100 * orders")} AS revenue_per_order FROM by_channel""",
        "top_products": f"{with_(PRODUCT_TOTALS)} SELECT * FROM by_product",
        "top_products_unknown_status": f"""{with_(PRODUCT_TOTALS.replace(KEPT, KNOWN_STATUS))}
SELECT * FROM by_product""",
        "customer_rfm_unknown_status": f"{with_(LEDGER.replace(KEPT, KNOWN_STATUS))} {RFM_OUT}",
        "category_summary_unknown_status": f"""{with_(CATEGORY.replace(KEPT, UNKNOWN_STATUS))}
{CATEGORY_OUT}""",
        "customer_rfm": f"{with_(LEDGER)} {RFM_OUT}",
        "best_products": f"""{with_(PRODUCT_TOTALS)}
SELECT product_id, category, total_revenue, avg_margin_pct FROM by_product
ORDER BY total_revenue DESC, product_id LIMIT 10""",
        "category_drill_through": f"""{with_(CATEGORY)}
SELECT category, year, month, {money("revenue_c")} AS revenue FROM by_category
UNION ALL
SELECT category, NULL, NULL, {money("sum(revenue_c)")} FROM by_category GROUP BY category""",
        "category_within_month": f"""{with_(CATEGORY, MONTHLY.removeprefix(LEDGER).lstrip(','))}
SELECT period, category, {money("c.revenue_c")} AS revenue,
       {money("m.revenue_c")} AS total_revenue,
       {up_ratio("100 * c.revenue_c", "m.revenue_c")} AS revenue_share_pct
FROM by_category c JOIN monthly m USING (year, month)""",
        "region_segment_matrix": f"""{with_(REGION.replace(LINES, UNFORESEEN))}
SELECT region, """
        + ", ".join(
            f"""{money(f"sum(revenue_c) FILTER (segment = '{s}')")} AS "{s}" """
            for s in ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "UNFORESEEN"]
        )
        + " FROM by_region GROUP BY region",
        "channel_stack": f"""{with_(CHANNEL)}
SELECT channel, campaign, {money("sum(revenue_c)")} AS revenue FROM by_channel
GROUP BY channel, campaign""",
        # series and forecasts
        "stored_monthly_series": f"""{with_(LINES, TOTAL, FEATURES)}
SELECT series, period, {money("revenue_c")} AS revenue, t FROM features""",
        "series_features": f"{with_(LINES, TOTAL, FEATURES)} {FEATURES_OUT} FROM features",
        "series_features_by_product": f"""{with_(LINES, BY_PRODUCT, FEATURES)}
{FEATURES_OUT} FROM features""",
        "train_test_split": f"""{with_(LINES, BY_CHANNEL, FEATURES)}
SELECT series, period, is_train FROM split""",
        "feature_scaling": f"""{with_(LINES, BY_CHANNEL, FEATURES)}
SELECT series, feature, {even("mean", 3)} AS mean, {even("scale", 3)} AS scale
FROM ({SCALING})""",
        "moving_average_forecast": f"""{with_(LINES, TOTAL, MOVING_AVERAGE)} SELECT * FROM walk""",
        "moving_average_by_product": f"""{with_(LINES, BY_PRODUCT, MOVING_AVERAGE)}
SELECT * FROM walk""",
        "future_features": f"""{with_(LINES, BY_CHANNEL, FEATURES, FUTURE)}
SELECT series, step, period, month, quarter, t, sin_month, cos_month, quarter_enc, ma_3, lag_1
FROM future""",
        "regression_forecast": f"""{with_(LINES, BY_CHANNEL, FEATURES, REGRESSION)}
SELECT series, step, period, lr_forecast FROM regressed""",
        "hold_out_predictions": f"""{with_(LINES, BY_CHANNEL, FEATURES, REGRESSION)}
SELECT series, period, actual, {even("predicted")} AS predicted FROM held""",
        "hold_out_metrics": f"""{with_(LINES, BY_CHANNEL, FEATURES, REGRESSION)}
SELECT series, {METRICS_OUT} FROM metrics""",
        "forecast_detail": f"""{with_(LINES, TOTAL, FEATURES, DETAIL)} SELECT * FROM detail""",
        "forecast_detail_by_product": f"""{with_(LINES, BY_PRODUCT, FEATURES, SHORTEST_DETAIL)}
SELECT series, period, type, {even("ma_3_forecast", 0)} AS ma_3_forecast,
       {even("lr_forecast", 0)} AS lr_forecast, {even("ensemble_forecast", 0)} AS ensemble_forecast
FROM detail""",
        "hold_out_metrics_by_product": f"""{with_(LINES, BY_PRODUCT, FEATURES, SHORTEST)}
SELECT series, test_rows, {even("mae", 1)} AS mae, {even("rmse", 1)} AS rmse, {even("r2", 3)} AS r2,
       {even("mape", 2)} AS mape, {even("100 - mape", 2)} AS accuracy FROM metrics""",
        "forecast_detail_by_category": f"""{with_(LEDGER, BY_CATEGORY, FEATURES, DETAIL)}
SELECT * FROM detail""",
        "actuals_and_forecast": f"""{with_(LINES, TOTAL, FEATURES, DETAIL)}
SELECT series, period, 'Actual' AS type, {money("revenue_c")} AS revenue FROM series
UNION ALL SELECT series, period, type, ensemble_forecast FROM detail""",
        "forecast_run_summary": f"""{with_(LINES, TOTAL, FEATURES, REGRESSION)}
SELECT series, (SELECT count(*) FROM split s WHERE is_train AND s.series = metrics.series)::INTEGER
         AS train_rows, {METRICS_OUT} FROM metrics""",
        # stored results
        "stored_ledger": f"{with_(LEDGER)} {LEDGER_OUT}",
        "ledger_of_a_quarter": f"{with_(LEDGER)} {LEDGER_OUT} WHERE year = 1996 AND quarter(date) = 2",
        "approximate_customers": f"""{with_(LINES)},
{KEPT_LINES}
SELECT 'month' AS level, year, month AS part, count(DISTINCT customer_id) AS customers, true AS is_near
FROM sold GROUP BY year, month
UNION ALL
SELECT 'quarter', year, quarter(date)::INTEGER AS quarter, count(DISTINCT customer_id), true
FROM sold GROUP BY year, quarter(date)::INTEGER
UNION ALL
SELECT 'year', year, 0, count(DISTINCT customer_id), true FROM sold GROUP BY year""",
        "approximate_thresholds": f"""{with_(LINES)}
SELECT year, count(revenue_c) AS rows, true AS is_near FROM lines GROUP BY year""",
        "stored_table_counts": f"{with_(LEDGER)} {TABLE_COUNTS} {SUMMARY_COUNTS}",
        "etl_audit": f"""{with_(LEDGER)}
SELECT 'load' AS stage, table_name AS metric, row_count AS value
FROM ({TABLE_COUNTS} {SUMMARY_COUNTS})
UNION ALL SELECT 'validate', unnest(['loaded', 'remaining']), count(*) FROM lines
UNION ALL SELECT 'validate',
  unnest(['duplicates', 'negative_revenue', 'non_positive_quantity', 'removed']), 0
UNION ALL SELECT 'nulls', 'campaign', count(*) FROM lines WHERE campaign IS NULL
UNION ALL SELECT 'unmatched', unnest(['customers', 'products']), 0""",
    }
