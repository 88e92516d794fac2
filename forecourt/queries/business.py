"""Business analysis queries."""

from __future__ import annotations

from forecourt.operators import analysis, gold
from forecourt.queries.marts import MARKET_MARGIN_SQL
from forecourt.queries.registry import TODAY, query, rounded
from forecourt.sources.bindings import AS_OF, with_tables

_CV = with_tables("sl_contracts", "sl_vehicles")
_MONTH = "CAST(date_trunc('month', c.contract_date) AS DATE)"
_PREVIOUS = "c.contract_date >= DATE '2001-07-01' AND c.contract_date < DATE '2001-08-01'"
_JOIN_V = "FROM sl_contracts c LEFT JOIN sl_vehicles v ON c.vehicle_id = v.vehicle_id"
_RM = with_tables("sl_customers", "sl_inquiries", "sl_contracts") + ", " + gold.RM_SEGMENT_SQL


@query(
    "q_top_store_prev_month",
    with_tables("sl_contracts", "sl_stores")
    + f"""
SELECT b.store_id, s.store_name, b.gross_profit FROM (
  SELECT c.store_id, round(sum(c.gross_profit), 4) AS gross_profit FROM sl_contracts c
  WHERE {_PREVIOUS} AND c.store_id IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1) b LEFT JOIN sl_stores s ON b.store_id = s.store_id""",
)
def top_store_prev_month(spark, t):
    """Best store of the previous month."""
    return analysis.top_store_prev_month(t, AS_OF)


@query(
    "q_store_ranking",
    with_tables("sl_contracts", "sl_stores")
    + f""", monthly AS (
  SELECT {_MONTH} AS month, c.store_id, s.prefecture, round(sum(c.gross_profit), 4) AS gross_profit
  FROM sl_contracts c LEFT JOIN sl_stores s ON c.store_id = s.store_id GROUP BY 1, 2, 3),
areas AS (SELECT month, prefecture, round(sum(gross_profit), 4) AS area_profit FROM monthly GROUP BY 1, 2),
ranked AS (SELECT *, dense_rank() OVER (PARTITION BY month ORDER BY area_profit DESC) AS area_rank FROM areas)
SELECT m.month, m.store_id, m.prefecture, m.gross_profit, r.area_profit, CAST(r.area_rank AS INT) AS area_rank,
  CAST(rank() OVER (PARTITION BY m.month ORDER BY m.gross_profit DESC) AS INT) AS store_rank
FROM monthly m LEFT JOIN ranked r ON m.month = r.month AND m.prefecture IS NOT DISTINCT FROM r.prefecture""",
)
def store_ranking(spark, t):
    """Stores and areas ranked by gross profit per month."""
    return analysis.store_ranking(t)


@query(
    "q_top3_segment",
    with_tables("sl_contracts", "sl_customers", "sl_vehicles")
    + """
SELECT segment, model, units, CAST(place AS INT) AS place FROM (
  SELECT k.segment, v.model, count(*) AS units,
    row_number() OVER (PARTITION BY k.segment ORDER BY count(*) DESC, v.model) AS place
  FROM sl_contracts c JOIN sl_customers k ON c.customer_id = k.customer_id
  JOIN sl_vehicles v ON c.vehicle_id = v.vehicle_id GROUP BY 1, 2) WHERE place <= 3""",
)
def top3_segment(spark, t):
    """Three most contracted models per customer segment."""
    return analysis.top3_segment(t)


_MARKET = with_tables("sl_contracts", "sl_vehicles", "sl_market_index") + ", " + MARKET_MARGIN_SQL


@query(
    "q_falling_index_sales",
    _MARKET
    + """
SELECT i.month, i.category, round(i.market_index, 6) AS market_index,
  round(i.index_change, 6) AS index_change, s.units, round(s.sales, 4) AS sales
FROM (SELECT a.*, a.market_index - b.market_index AS index_change FROM idx a JOIN idx b
    ON a.category = b.category AND b.month = a.month - INTERVAL 1 MONTH) i JOIN sales s ON i.month = s.month AND i.category = s.category WHERE i.index_change < 0""",
)
def falling_index_sales(spark, t):
    """Sales in months when the market index fell."""
    out = analysis.falling_index_sales(t)
    return rounded(out, {"market_index": 6, "index_change": 6, "sales": 4})


@query(
    "q_margin_by_repair",
    _CV
    + f"""
SELECT c.store_id, count(*) AS units,
  round(sum(c.gross_profit) FILTER (WHERE v.repair_history = 'あり')
    / nullif(sum(c.actual_price) FILTER (WHERE v.repair_history = 'あり'), 0), 6) AS margin_repaired,
  round(sum(c.gross_profit) FILTER (WHERE v.repair_history = 'なし')
    / nullif(sum(c.actual_price) FILTER (WHERE v.repair_history = 'なし'), 0), 6) AS margin_unrepaired
{_JOIN_V} GROUP BY 1""",
)
def margin_by_repair(spark, t):
    """Margin rate with and without repair history, per store."""
    out = analysis.margin_by_repair(t)
    return rounded(out, {"margin_repaired": 6, "margin_unrepaired": 6})


@query(
    "q_market_gap",
    _MARKET
    + """, linked AS (
  SELECT month, category, market_index, gross_profit / nullif(sales, 0) AS margin_rate
  FROM sales JOIN idx USING (month, category))
SELECT month, category, round(market_index, 6) AS market_index, round(margin_rate, 6) AS margin_rate,
  round(market_index / avg(market_index) OVER c, 6) AS index_level,
  round(market_index / avg(market_index) OVER c
    - margin_rate / nullif(avg(margin_rate) OVER c, 0), 4) AS gap
FROM linked WINDOW c AS (PARTITION BY category)""",
)
def market_gap(spark, t):
    """Drift between market index and margin rate."""
    out = analysis.market_gap(t)
    return rounded(out, {"market_index": 6, "margin_rate": 6, "index_level": 6, "gap": 4})


@query(
    "q_turnover_days",
    _CV
    + f"""
SELECT coalesce(a.body_type, b.body_type) AS body_type, a.units_sold,
  round(a.avg_days_to_sale, 6) AS avg_days_to_sale, b.units_in_stock,
  round(b.avg_days_in_stock, 6) AS avg_days_in_stock
FROM (SELECT v.body_type, count(*) AS units_sold, avg(c.contract_date - v.stocked_date) AS avg_days_to_sale
    FROM sl_contracts c JOIN sl_vehicles v ON c.vehicle_id = v.vehicle_id
    WHERE c.contract_date >= v.stocked_date GROUP BY 1) a
FULL JOIN (SELECT body_type, count(*) AS units_in_stock, avg({TODAY} - stocked_date) AS avg_days_in_stock
    FROM sl_vehicles WHERE status = '在庫中' GROUP BY 1) b ON a.body_type IS NOT DISTINCT FROM b.body_type""",
)
def turnover_days(spark, t):
    """Days to sale and days in stock, by body type."""
    out = analysis.turnover_days(t, AS_OF)
    return rounded(out, {"avg_days_to_sale": 6, "avg_days_in_stock": 6})


@query(
    "q_aged_stock",
    with_tables("sl_vehicles")
    + f"""
SELECT body_type, CASE WHEN days <= 270 THEN '180-270' WHEN days <= 365 THEN '271-365'
    WHEN days <= 455 THEN '366-455' ELSE '456+' END AS days_band, count(*) AS vehicles,
  round(sum(listing_price), 4) AS listing_price, CAST(max(days) AS INT) AS max_days
FROM (SELECT *, {TODAY} - stocked_date AS days FROM sl_vehicles WHERE status = '在庫中')
WHERE days >= 180 GROUP BY 1, 2""",
)
def aged_stock(spark, t):
    """Vehicles long in stock."""
    return analysis.aged_stock(t, AS_OF)


@query(
    "q_funnel",
    with_tables("sl_inquiries", "sl_contracts")
    + """
SELECT i.channel, i.store_id, count(*) AS inquiries, count(*) FILTER (WHERE i.status = '成約') AS won,
  count(k.n) AS with_contract, CAST(coalesce(sum(k.n), 0) AS BIGINT) AS contracts,
  coalesce(round(sum(k.sales), 4), 0.0) AS sales, round(count(k.n) / count(*), 6) AS contract_rate
FROM sl_inquiries i LEFT JOIN (SELECT inquiry_id, count(*) AS n, sum(actual_price) AS sales
  FROM sl_contracts GROUP BY 1) k ON i.inquiry_id = k.inquiry_id GROUP BY 1, 2""",
)
def funnel(spark, t):
    """From inquiry to contract."""
    return rounded(analysis.funnel(t), {"contract_rate": 6})


@query(
    "q_store_decline",
    with_tables("sl_contracts")
    + f""", monthly AS (
  SELECT c.store_id, {_MONTH} AS month, round(sum(c.gross_profit), 4) AS gross_profit FROM sl_contracts c
  WHERE c.store_id IS NOT NULL AND c.contract_date IS NOT NULL GROUP BY 1, 2),
calendar AS (
  SELECT s.store_id, CAST(m.month AS DATE) AS month
  FROM (SELECT store_id, min(month) AS first FROM monthly GROUP BY 1) s
  JOIN (SELECT unnest(generate_series((SELECT min(month) FROM monthly), (SELECT max(month) FROM monthly),
      INTERVAL 1 MONTH)) AS month) m ON m.month >= s.first),
filled AS (SELECT store_id, month, coalesce(gross_profit, 0.0) AS gross_profit
  FROM calendar LEFT JOIN monthly USING (store_id, month))
SELECT n.store_id, n.month, n.gross_profit, round(avg(e.gross_profit), 6) AS earlier_mean,
  round(n.gross_profit / avg(e.gross_profit) - 1, 6) AS change
FROM filled n JOIN filled e ON e.store_id = n.store_id AND e.month < n.month AND e.month >= n.month - INTERVAL 3 MONTH
GROUP BY 1, 2, 3 HAVING count(*) = 3 AND avg(e.gross_profit) > 0 AND n.gross_profit / avg(e.gross_profit) - 1 <= -0.3""",
)
def store_decline(spark, t):
    """Store months that fell well below the months before."""
    return rounded(analysis.store_decline(t), {"earlier_mean": 6, "change": 6})


@query(
    "q_store_corr",
    with_tables("sl_contracts", "sl_inquiries", "sl_vehicles", "sl_customers", "sl_stores")
    + """
SELECT count(*) AS stores, round(corr(coalesce(sales, 0), coalesce(won, 0)), 6) AS sales_vs_won,
  round(corr(coalesce(sales, 0), coalesce(stock_value, 0)), 6) AS sales_vs_stock_value,
  round(corr(coalesce(sales, 0), coalesce(budgets, 0)), 6) AS sales_vs_budgets
FROM sl_stores
LEFT JOIN (SELECT store_id, sum(actual_price) AS sales FROM sl_contracts GROUP BY 1) USING (store_id)
LEFT JOIN (SELECT store_id, count(*) FILTER (WHERE status = '成約') AS won FROM sl_inquiries GROUP BY 1) USING (store_id)
LEFT JOIN (SELECT store_id, sum(listing_price) AS stock_value FROM sl_vehicles GROUP BY 1) USING (store_id)
LEFT JOIN (SELECT registered_store_id AS store_id, sum(budget) AS budgets FROM sl_customers GROUP BY 1) USING (store_id)""",
)
def store_corr(spark, t):
    """Correlation of store-level figures."""
    names = ("sales_vs_won", "sales_vs_stock_value", "sales_vs_budgets")
    return rounded(analysis.store_corr(t), dict.fromkeys(names, 6))


_HEAT_MONTHS = [analysis.months_before(AS_OF, n) for n in range(12, 0, -1)]


@query(
    "q_heatmap",
    with_tables("sl_contracts")
    + "\nSELECT store_id, "
    + ", ".join(
        f"count(*) FILTER (WHERE month = DATE '{m}') AS units_{m:%Y_%m}, "
        f"round(sum(gross_profit) FILTER (WHERE month = DATE '{m}') "
        f"/ nullif(sum(actual_price) FILTER (WHERE month = DATE '{m}'), 0), 6) AS margin_{m:%Y_%m}"
        for m in _HEAT_MONTHS
    )
    + f"""
FROM (SELECT c.*, {_MONTH} AS month FROM sl_contracts c) c
WHERE month >= DATE '2000-08-01' AND month < DATE '2001-08-01' GROUP BY 1""",
)
def heatmap(spark, t):
    """Store by month: units and margin rate over the last twelve months."""
    return analysis.heatmap(t, AS_OF)


@query(
    "q_composition",
    _CV
    + f"""
SELECT v.body_type, count(*) AS units, round(sum(c.actual_price), 4) AS sales,
  round(count(*) / sum(count(*)) OVER (), 6) AS unit_share,
  round(sum(c.actual_price) / sum(sum(c.actual_price)) OVER (), 6) AS sales_share
{_JOIN_V} GROUP BY 1""",
)
def composition(spark, t):
    """Share of each body type in units and sales."""
    return rounded(analysis.composition(t), {"unit_share": 6, "sales_share": 6})


@query(
    "q_scatter",
    with_tables("sl_vehicles")
    + "\nSELECT vehicle_id, model_year, listing_price, body_type FROM sl_vehicles",
)
def scatter(spark, t):
    """Model year, price and body type of every vehicle."""
    return analysis.scatter(t)


@query(
    "q_ltv",
    _RM
    + """
SELECT c.segment, count(*) AS customers, count(*) FILTER (WHERE r.n_contracts > 0) AS buyers,
  round(sum(r.total_value), 4) AS total_value, round(avg(r.total_value), 2) AS value_per_customer,
  round(sum(r.total_value) / nullif(sum(r.n_contracts), 0), 2) AS value_per_contract
FROM rm r JOIN sl_customers c ON r.customer_id = c.customer_id GROUP BY 1""",
)
def ltv(spark, t):
    """Customer value by market segment."""
    return rounded(analysis.ltv(t, AS_OF), {"value_per_customer": 2, "value_per_contract": 2})


@query(
    "q_dormant",
    _RM
    + """
SELECT customer_id, months_since, rm_segment, round(total_value, 4) AS total_value
FROM rm WHERE months_since IS NULL OR months_since > 12""",
)
def dormant(spark, t):
    """Customers out of contact for more than a year."""
    return analysis.dormant(t, AS_OF)


@query(
    "q_vip_churn",
    _RM
    + """
SELECT customer_id, months_since, n_contracts, round(total_value, 4) AS total_value
FROM rm WHERE value_band = 'M3' AND (months_since IS NULL OR months_since >= 6)""",
)
def vip_churn(spark, t):
    """High-value customers drifting away."""
    return analysis.vip_churn(t, AS_OF)


@query(
    "q_margin_drop",
    _CV
    + f""", period AS (
  SELECT v.body_type, c.contract_date >= DATE '2001-05-01' AS late, count(*) AS u, sum(c.gross_profit) AS g,
    sum(c.actual_price) / nullif(count(*), 0) AS p, sum(c.gross_profit) / nullif(sum(c.actual_price), 0) AS m
  {_JOIN_V} WHERE c.contract_date >= DATE '2001-02-01' AND c.contract_date < DATE '2001-08-01' GROUP BY 1, 2),
both_periods AS (
  SELECT coalesce(a.body_type, b.body_type) AS body_type, coalesce(a.u, 0) AS u0, coalesce(a.g, 0) AS g0,
    coalesce(a.p, 0) AS p0, coalesce(a.m, 0) AS m0, coalesce(b.u, 0) AS u1, coalesce(b.g, 0) AS g1,
    coalesce(b.p, 0) AS p1, coalesce(b.m, 0) AS m1
  FROM (SELECT * FROM period WHERE NOT late) a FULL JOIN (SELECT * FROM period WHERE late) b
    ON a.body_type IS NOT DISTINCT FROM b.body_type)
SELECT body_type, u0 AS units_before, u1 AS units_after, round(g1 - g0, 2) AS profit_change,
  round((u1 - u0) * p0 * m0, 2) AS volume_effect, round(u1 * (p1 - p0) * m0, 2) AS price_effect,
  round(u1 * p1 * (m1 - m0), 2) AS margin_effect FROM both_periods""",
)
def margin_drop(spark, t):
    """Why gross profit changed between two quarters."""
    names = ("profit_change", "volume_effect", "price_effect", "margin_effect")
    return rounded(analysis.margin_drop(t, AS_OF), dict.fromkeys(names, 2))


@query(
    "q_top_model_prev_month",
    _CV
    + f"""
SELECT v.model, count(*) AS units {_JOIN_V} WHERE {_PREVIOUS} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
)
def top_model_prev_month(spark, t):
    """Most contracted model of the previous month."""
    return analysis.top_model_prev_month(t, AS_OF)


@query(
    "q_trend",
    _CV
    + f""", sales AS (
  SELECT v.body_type, {_MONTH} AS month, count(*) AS units, sum(c.actual_price) AS sales
  {_JOIN_V} WHERE c.contract_date IS NOT NULL GROUP BY 1, 2)
SELECT s.body_type, s.month, s.units, round(s.sales, 4) AS sales,
  round(s.sales / nullif(max(b.sales) FILTER (WHERE b.month = s.month - INTERVAL 1 MONTH), 0) - 1, 6) AS change,
  round(avg(b.sales), 6) AS three_month_mean
FROM sales s JOIN sales b ON s.body_type IS NOT DISTINCT FROM b.body_type
  AND b.month <= s.month AND b.month >= s.month - INTERVAL 2 MONTH GROUP BY s.body_type, s.month, s.units, s.sales""",
)
def trend(spark, t):
    """Monthly trend per body type."""
    return rounded(analysis.trend(t), {"change": 6, "three_month_mean": 6})


def _line_sql(seen: str, out: str, source: str) -> str:
    """``source`` with the line through ``seen`` and the mean distance of the calendar month from it, as ``out``."""
    return f"""SELECT * EXCLUDE (line), line + coalesce(avg({seen} - line) OVER (PARTITION BY category, month(month)), 0) AS {out}
  FROM (SELECT *, coalesce(regr_intercept({seen}, idx) OVER g, avg({seen}) OVER g) + coalesce(regr_slope({seen}, idx) OVER g, 0) * idx AS line
    FROM {source} WINDOW g AS (PARTITION BY category))"""


@query(
    "q_forecast",
    with_tables("sl_contracts", "sl_vehicles")
    + f""",
known AS (
  SELECT v.body_type AS category, CAST(date_trunc('month', c.contract_date) AS DATE) AS month, sum(c.actual_price) AS sales
  FROM sl_contracts c LEFT JOIN sl_vehicles v ON c.vehicle_id = v.vehicle_id WHERE c.contract_date < {TODAY} GROUP BY 1, 2),
spine AS (
  SELECT category, CAST(unnest(generate_series(min(month), {TODAY} + INTERVAL 2 MONTH, INTERVAL 1 MONTH)) AS DATE) AS month
  FROM known GROUP BY category),
series AS (
  SELECT s.category, s.month, CAST(datediff('month', min(s.month) OVER (PARTITION BY s.category), s.month) AS DOUBLE) AS idx,
    CASE WHEN s.month < {TODAY} THEN coalesce(k.sales, 0) END AS seen,
    CASE WHEN s.month < {TODAY} - INTERVAL 3 MONTH THEN coalesce(k.sales, 0) END AS early
  FROM spine s LEFT JOIN known k ON k.category IS NOT DISTINCT FROM s.category AND k.month = s.month),
ahead AS ({_line_sql("seen", "forecast", "series")}),
back AS ({_line_sql("early", "back", "ahead")})
SELECT category, month, round(forecast, 1) AS forecast, round(backtest_mae, 1) AS backtest_mae, n_months
FROM (SELECT *, avg(CASE WHEN early IS NULL THEN abs(seen - back) END) OVER (PARTITION BY category) AS backtest_mae,
  count(seen) OVER (PARTITION BY category) AS n_months FROM back)
WHERE month >= {TODAY}""",
)
def forecast(spark, t):
    """Sales of the next three months by category, with the error that the same forecast made on the last three."""
    sales = gold.sales_by_vehicle_attribute(
        t["sl_contracts"], t["sl_vehicles"], "body_type", gold.month_of("contract_date").alias("month")
    ).withColumnRenamed("body_type", "category")
    return rounded(analysis.seasonal_forecast(sales, "category", "sales", AS_OF), {"forecast": 1, "backtest_mae": 1})
