"""Silver and gold tables, and masked views of the masters."""

from __future__ import annotations

from pyspark.sql import functions as F

from forecourt.functions import masking
from forecourt.operators import gold, silver
from forecourt.queries.registry import query, rounded
from forecourt.sources.bindings import AS_OF, with_tables

_CONTRACTS = with_tables("sl_contracts")

# The test data's part types stand for the body types, in this order.
CATEGORIES = {
    "ECONOMY": "軽自動車",
    "SMALL": "コンパクト",
    "STANDARD": "セダン",
    "LARGE": "SUV",
    "MEDIUM": "ミニバン",
    "PROMO": "輸入車",
}
_CATEGORY_SQL = "CASE {c} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CATEGORIES.items()) + " END"
_SUMS = {"sales": 4, "gross_profit": 4}


@query(
    "silver_contracts",
    with_tables("sl_contracts", "sl_stores", "sl_vehicles")
    + f"""
SELECT c.contract_id, c.contract_date, CAST(date_trunc('month', c.contract_date) AS DATE) AS sales_month,
  c.store_id, trim(s.store_name) AS store_name, trim(s.prefecture) AS prefecture, c.vehicle_id,
  trim(v.maker) AS maker, {_CATEGORY_SQL.format(c="v.body_type")} AS category, c.customer_id,
  c.actual_price, c.gross_profit, round(c.gross_profit / nullif(c.actual_price, 0), 6) AS margin_rate
FROM sl_contracts c LEFT JOIN sl_stores s ON c.store_id = s.store_id
LEFT JOIN sl_vehicles v ON c.vehicle_id = v.vehicle_id""",
)
def silver_contracts(spark, t):
    """Contracts joined to their store and vehicle, names trimmed, category aligned."""
    out = silver.to_silver(t["sl_contracts"], t["sl_stores"], t["sl_vehicles"], CATEGORIES)
    return rounded(out, {"margin_rate": 6})


@query(
    "silver_category",
    with_tables("sl_vehicles")
    + f"""
SELECT body_type, {_CATEGORY_SQL.format(c="body_type")} AS category, count(*) AS n
FROM sl_vehicles GROUP BY 1, 2""",
)
def silver_category(spark, t):
    """Category spellings mapped to one vocabulary, regardless of case and padding."""
    noisy = F.concat(F.lit(" "), F.lower("body_type"))
    vehicles = t["sl_vehicles"].select(
        "body_type", silver.map_category(noisy, CATEGORIES).alias("category")
    )
    return vehicles.groupBy("body_type", "category").agg(F.count(F.lit(1)).alias("n"))


@query(
    "gold_store_monthly",
    _CONTRACTS
    + """
SELECT store_id, CAST(date_trunc('month', contract_date) AS DATE) AS sales_month, count(*) AS units,
  round(sum(actual_price), 4) AS sales, round(sum(gross_profit), 4) AS gross_profit
FROM sl_contracts GROUP BY 1, 2""",
)
def store_monthly(spark, t):
    """Units, sales and gross profit by store and month."""
    return rounded(gold.store_monthly_sales(t["sl_contracts"]), _SUMS)


@query(
    "gold_inventory",
    with_tables("sl_vehicles")
    + """
SELECT body_type, status, count(*) AS vehicles, round(avg(listing_price), 6) AS avg_listing_price,
  round(sum(listing_price), 4) AS listing_total, round(sum(purchase_price), 4) AS purchase_total
FROM sl_vehicles GROUP BY 1, 2""",
)
def inventory(spark, t):
    """Stock by body type and status."""
    out = gold.inventory_summary(t["sl_vehicles"])
    return rounded(out, {"avg_listing_price": 6, "listing_total": 4, "purchase_total": 4})


MARKET_MARGIN_SQL = """sales AS (
  SELECT CAST(date_trunc('month', c.contract_date) AS DATE) AS month, v.body_type AS category,
    count(*) AS units, sum(c.actual_price) AS sales, sum(c.gross_profit) AS gross_profit
  FROM sl_contracts c LEFT JOIN sl_vehicles v ON c.vehicle_id = v.vehicle_id GROUP BY 1, 2),
idx AS (
  SELECT CAST(date_trunc('month', date) AS DATE) AS month, vehicle_category AS category,
    avg(market_index) AS market_index FROM sl_market_index GROUP BY 1, 2)"""


@query(
    "gold_market_margin",
    with_tables("sl_contracts", "sl_vehicles", "sl_market_index")
    + ", "
    + MARKET_MARGIN_SQL
    + """
SELECT month, category, units, round(sales, 4) AS sales, round(gross_profit, 4) AS gross_profit,
  round(gross_profit / nullif(sales, 0), 6) AS margin_rate, round(market_index, 6) AS market_index
FROM sales JOIN idx USING (month, category)""",
)
def market_margin(spark, t):
    """Market index next to the margin rate, by month and category."""
    out = gold.market_linked_margin(t["sl_contracts"], t["sl_vehicles"], t["sl_market_index"])
    return rounded(out, {**_SUMS, "margin_rate": 6, "market_index": 6})


@query(
    "gold_margin_score",
    with_tables("sl_contracts", "sl_vehicles")
    + """
SELECT contract_id, month, store_id, category, round(margin_rate, 6) AS margin_rate,
  round((margin_rate - avg(margin_rate) OVER g) / nullif(stddev_pop(margin_rate) OVER g, 0), 4) AS score
FROM (SELECT c.contract_id, CAST(date_trunc('month', c.contract_date) AS DATE) AS month, c.store_id,
    v.body_type AS category, c.gross_profit / nullif(c.actual_price, 0) AS margin_rate
  FROM sl_contracts c LEFT JOIN sl_vehicles v ON c.vehicle_id = v.vehicle_id)
WINDOW g AS (PARTITION BY month, store_id, category)""",
)
def margin_score(spark, t):
    """Standard score of each contract's margin among its peers."""
    out = gold.margin_score(t["sl_contracts"], t["sl_vehicles"])
    return rounded(out, {"margin_rate": 6, "score": 4})


@query(
    "gold_rm_segment",
    with_tables("sl_customers", "sl_inquiries", "sl_contracts")
    + ", "
    + gold.RM_SEGMENT_SQL
    + """
SELECT customer_id, months_since, round(total_value, 4) AS total_value, n_contracts,
  recency_band, value_band, rm_segment FROM rm""",
)
def rm_segment(spark, t):
    """Customers by months since last contact and cumulative value."""
    out = gold.rm_segment(t["sl_customers"], t["sl_inquiries"], t["sl_contracts"], AS_OF)
    return rounded(out, {"total_value": 4})


@query(
    "mv_monthly_sales",
    _CONTRACTS
    + """
SELECT CAST(date_trunc('month', contract_date) AS DATE) AS sales_month, count(*) AS units,
  round(sum(actual_price), 4) AS sales, round(sum(gross_profit), 4) AS gross_profit,
  round(sum(gross_profit) / nullif(sum(actual_price), 0), 6) AS margin_rate
FROM sl_contracts GROUP BY 1""",
)
def monthly_sales(spark, t):
    """Monthly sales summary."""
    return rounded(gold.monthly_sales(t["sl_contracts"]), {**_SUMS, "margin_rate": 6})


@query(
    "mv_dashboard_kpi",
    _CONTRACTS
    + """
SELECT CAST(date_trunc('month', contract_date) AS DATE) AS sales_month, false AS is_total,
  count(*) AS units, round(sum(actual_price), 4) AS sales, round(sum(gross_profit), 4) AS gross_profit,
  count(DISTINCT customer_id) AS customers,
  round(sum(gross_profit) / nullif(sum(actual_price), 0), 6) AS margin_rate
FROM sl_contracts GROUP BY 1
UNION ALL
SELECT NULL, true, count(*), round(sum(actual_price), 4), round(sum(gross_profit), 4),
  count(DISTINCT customer_id), round(sum(gross_profit) / nullif(sum(actual_price), 0), 6)
FROM sl_contracts""",
)
def dashboard_kpi(spark, t):
    """Dashboard figures by month and in total."""
    return rounded(gold.dashboard_kpi(t["sl_contracts"]), {**_SUMS, "margin_rate": 6})


@query(
    "mask_name",
    with_tables("sl_customers") + "\nSELECT customer_id, repeat('*', length(name)) AS name FROM sl_customers",
)
def mask_name(spark, t):
    """Names hidden."""
    return t["sl_customers"].select("customer_id", masking.mask_name("name").alias("name"))


@query(
    "mask_phone",
    with_tables("sl_customers")
    + """
SELECT customer_id, regexp_replace(substr(phone, 1, length(phone) - 4), '[0-9]', '*', 'g')
  || substr(phone, length(phone) - 3) AS phone FROM sl_customers""",
)
def mask_phone(spark, t):
    """All but the last four digits hidden."""
    return t["sl_customers"].select("customer_id", masking.mask_phone("phone").alias("phone"))


@query(
    "mask_vin",
    with_tables("sl_vehicles") + "\nSELECT vehicle_id, repeat('*', 17) AS vin FROM sl_vehicles",
)
def mask_vin(spark, t):
    """Identifiers hidden."""
    return t["sl_vehicles"].select("vehicle_id", masking.mask_vin("vin").alias("vin"))


@query(
    "mask_plate",
    with_tables("sl_vehicles")
    + "\nSELECT vehicle_id, regexp_replace(plate_number, '.', '*', 'g') AS plate_number FROM sl_vehicles",
)
def mask_plate(spark, t):
    """Number plates hidden."""
    return t["sl_vehicles"].select(
        "vehicle_id", masking.mask_plate("plate_number").alias("plate_number")
    )


@query(
    "masked_customers",
    with_tables("sl_customers")
    + """
SELECT customer_id, repeat('*', length(name)) AS name, registered_store_id, area, segment, budget,
  regexp_replace(substr(phone, 1, length(phone) - 4), '[0-9]', '*', 'g')
  || substr(phone, length(phone) - 3) AS phone FROM sl_customers""",
)
def masked_customers(spark, t):
    """The customer master as a reader without privileges sees it."""
    return masking.apply_masks(t["sl_customers"], masking.CUSTOMER_MASKS, privileged=False)
