"""Metric-view queries."""

from __future__ import annotations

from forecourt.operators import gold
from forecourt.plans.spec import Measure
from forecourt.plans.summaries import build_summary, query_from_summaries
from forecourt.plans.views import KPI_CUSTOMER, KPI_INQUIRY, KPI_INVENTORY, KPI_SALES
from forecourt.queries.registry import TODAY, query, rounded
from forecourt.session import working_folder
from forecourt.sources.bindings import AS_OF, with_tables

_SALES = with_tables("sl_contracts", "sl_stores", "sl_vehicles")
_FROM_SALES = """FROM sl_contracts c
LEFT JOIN sl_stores s ON c.store_id = s.store_id
LEFT JOIN sl_vehicles v ON c.vehicle_id = v.vehicle_id"""
_STOCK = with_tables("sl_vehicles", "sl_stores")
_FROM_STOCK = "FROM sl_vehicles v LEFT JOIN sl_stores s ON v.store_id = s.store_id"
_LEADS = with_tables("sl_inquiries", "sl_stores")

# Digits compared. A sum of ten-thousandths divided by a count often ends in an
# exact half at six digits, which engines round differently; hence two for means.
MONEY, RATIO, MEAN = 4, 6, 2


@query(
    "kpi_sales_month_format",
    with_tables("sl_contracts", "sl_stores")
    + """
SELECT CAST(date_trunc('month', c.contract_date) AS DATE) AS "契約年月", s.format AS "店舗業態",
  count(*) AS "契約件数", round(sum(c.actual_price), 4) AS "売上合計",
  round(sum(c.gross_profit) / nullif(sum(c.actual_price), 0), 6) AS "加重平均粗利率"
FROM sl_contracts c LEFT JOIN sl_stores s ON c.store_id = s.store_id GROUP BY 1, 2""",
)
def sales_month_format(spark, t):
    """Monthly sales by store format: count, sum and a ratio of sums."""
    out = KPI_SALES.query(
        spark,
        dims=["契約年月", "店舗業態"],
        measures=["契約件数", "売上合計", "加重平均粗利率"],
        order_by=["契約年月", "店舗業態"],
        tables=t,
    )
    return rounded(out, {"売上合計": MONEY, "加重平均粗利率": RATIO})


@query(
    "kpi_sales_star",
    _SALES
    + f"""
SELECT s.prefecture AS "都道府県", v.maker AS "メーカー", count(*) AS "契約件数",
  round(sum(c.actual_price), 4) AS "売上合計" {_FROM_SALES} GROUP BY 1, 2""",
)
def sales_star(spark, t):
    """Two joins from one fact."""
    out = KPI_SALES.query(spark, ["都道府県", "メーカー"], ["契約件数", "売上合計"], tables=t)
    return rounded(out, {"売上合計": MONEY})


@query(
    "kpi_pruned_join",
    with_tables("sl_contracts", "sl_stores")
    + """
SELECT s.format AS "店舗業態", count(*) AS "契約件数", round(avg(c.actual_price), 2) AS "平均販売価格"
FROM sl_contracts c LEFT JOIN sl_stores s ON c.store_id = s.store_id GROUP BY 1""",
)
def pruned_join(spark, t):
    """The vehicle join is declared but not needed, so it is left out of the plan."""
    out = KPI_SALES.query(spark, ["store format"], ["契約件数", "avg price"], tables=t)
    return rounded(out, {"平均販売価格": MEAN})


@query(
    "kpi_weighted_margin",
    _SALES
    + f"""
SELECT v.body_type AS "ボディタイプ", round(sum(c.gross_profit), 4) AS "粗利合計",
  round(sum(c.actual_price), 4) AS "売上合計",
  round(sum(c.gross_profit) / nullif(sum(c.actual_price), 0), 6) AS "加重平均粗利率"
{_FROM_SALES} GROUP BY 1""",
)
def weighted_margin(spark, t):
    """A measure composed of two others."""
    out = KPI_SALES.query(
        spark, ["ボディタイプ"], ["粗利合計", "売上合計", "加重平均粗利率"], tables=t
    )
    return rounded(out, {"粗利合計": MONEY, "売上合計": MONEY, "加重平均粗利率": RATIO})


@query(
    "kpi_age_band",
    _SALES
    + f"""
SELECT CASE WHEN year({TODAY}) - v.model_year <= 3 THEN '3年以内'
    WHEN year({TODAY}) - v.model_year <= 7 THEN '4-7年'
    WHEN year({TODAY}) - v.model_year <= 10 THEN '8-10年' ELSE '10年超' END AS "年式区分",
  count(*) AS "契約件数", round(sum(c.gross_profit), 4) AS "粗利合計" {_FROM_SALES} GROUP BY 1""",
)
def age_band(spark, t):
    """Vehicle age in four bands, counted from a fixed day."""
    out = KPI_SALES.query(spark, ["年式区分"], ["契約件数", "粗利合計"], tables=t, as_of=AS_OF)
    return rounded(out, {"粗利合計": MONEY})


@query(
    "kpi_certified_label",
    _SALES
    + f"""
SELECT CASE WHEN v.certified THEN '認定' ELSE '非認定' END AS "認定中古車",
  v.repair_history AS "修復歴", count(*) AS "契約件数" {_FROM_SALES} GROUP BY 1, 2""",
)
def certified_label(spark, t):
    """A boolean as a label; an unknown flag counts as not certified."""
    return KPI_SALES.query(spark, ["認定中古車", "修復歴"], ["契約件数"], tables=t)


@query(
    "kpi_unique_customers",
    with_tables("sl_contracts")
    + """
SELECT CAST(date_trunc('month', contract_date) AS DATE) AS "契約年月",
  count(DISTINCT customer_id) AS "ユニーク顧客数" FROM sl_contracts GROUP BY 1""",
)
def unique_customers(spark, t):
    """Distinct customers per month."""
    return KPI_SALES.query(spark, ["契約年月"], ["ユニーク顧客数"], tables=t)


@query(
    "kpi_sales_per_customer",
    _SALES
    + f"""
SELECT s.store_name AS "店舗名", count(DISTINCT c.customer_id) AS "ユニーク顧客数",
  round(sum(c.actual_price) / nullif(count(DISTINCT c.customer_id), 0), 2) AS "顧客あたり売上"
{_FROM_SALES} GROUP BY 1""",
)
def sales_per_customer(spark, t):
    """Sales divided by distinct customers."""
    out = KPI_SALES.query(spark, ["店舗名"], ["ユニーク顧客数", "顧客あたり売上"], tables=t)
    return rounded(out, {"顧客あたり売上": MEAN})


@query(
    "kpi_share_measures",
    _SALES
    + f"""
SELECT s.format AS "店舗業態",
  round(count(*) FILTER (WHERE v.certified = true) / nullif(count(*), 0), 6) AS "認定中古車販売比率"
{_FROM_SALES} GROUP BY 1""",
)
def share_measures(spark, t):
    """Share of certified vehicles, the condition being on a joined column."""
    out = KPI_SALES.query(spark, ["店舗業態"], ["認定中古車販売比率"], tables=t)
    return rounded(out, {"認定中古車販売比率": RATIO})


@query(
    "kpi_filtered_sum",
    with_tables("sl_contracts")
    + """
SELECT CAST(date_trunc('month', contract_date) AS DATE) AS "契約年月",
  round(sum(actual_price) FILTER (WHERE gross_profit > 0), 4) AS "黒字売上"
FROM sl_contracts GROUP BY 1""",
)
def filtered_sum(spark, t):
    """A filtered sum added to a built-in view."""
    view = KPI_SALES.extend(
        Measure("黒字売上", "SUM(source.actual_price) FILTER (WHERE source.gross_profit > 0)")
    )
    return rounded(view.query(spark, ["契約年月"], ["黒字売上"], tables=t), {"黒字売上": MONEY})


@query(
    "kpi_where",
    _SALES
    + f"""
SELECT v.maker AS "メーカー", count(*) AS "契約件数", round(sum(c.actual_price), 4) AS "売上合計"
{_FROM_SALES} WHERE s.prefecture IN ('NATION_3', 'NATION_7', 'NATION_9')
  AND c.contract_date >= DATE '1998-01-01' GROUP BY 1""",
)
def where(spark, t):
    """Filter on dimension names before grouping."""
    out = KPI_SALES.query(
        spark,
        ["メーカー"],
        ["契約件数", "売上合計"],
        where="`都道府県` IN ('NATION_3', 'NATION_7', 'NATION_9')"
        " AND `契約日` >= DATE'1998-01-01'",
        tables=t,
    )
    return rounded(out, {"売上合計": MONEY})


@query(
    "kpi_inventory_area",
    _STOCK
    + f"""
SELECT s.prefecture AS "都道府県", count(*) AS "在庫台数",
  round(avg(v.listing_price), 6) AS "平均販売予定価格",
  round(count(*) FILTER (WHERE v.certified = true) / nullif(count(*), 0), 6) AS "認定中古車比率",
  round(count(*) FILTER (WHERE v.repair_history = 'あり') / nullif(count(*), 0), 6) AS "修復歴あり比率"
{_FROM_STOCK} GROUP BY 1""",
)
def inventory_area(spark, t):
    """Stock by area, grouped by whatever dimension is listed."""
    out = KPI_INVENTORY.query(
        spark,
        ["都道府県"],
        ["在庫台数", "平均販売予定価格", "認定中古車比率", "修復歴あり比率"],
        tables=t,
    )
    return rounded(
        out, {"平均販売予定価格": RATIO, "認定中古車比率": RATIO, "修復歴あり比率": RATIO}
    )


@query(
    "kpi_top_areas",
    _STOCK
    + f"""
SELECT s.prefecture AS "都道府県", count(*) AS "在庫台数",
  round(avg(v.listing_price), 6) AS "平均販売予定価格"
{_FROM_STOCK} GROUP BY 1 ORDER BY count(*) DESC NULLS LAST, s.prefecture ASC NULLS FIRST LIMIT 10""",
)
def top_areas(spark, t):
    """The ten areas with most stock; equal counts are ordered by area."""
    out = KPI_INVENTORY.query(
        spark,
        ["都道府県"],
        ["在庫台数", "平均販売予定価格"],
        order_by=[("在庫台数", "desc")],
        limit=10,
        tables=t,
    )
    return rounded(out, {"平均販売予定価格": RATIO})


@query(
    "kpi_mileage_band",
    _STOCK
    + f"""
SELECT CASE WHEN v.mileage_km < 30000 THEN '〜3万km' WHEN v.mileage_km < 60000 THEN '3-6万km'
    WHEN v.mileage_km < 100000 THEN '6-10万km' ELSE '10万km超' END AS "走行距離区分",
  count(*) AS "在庫台数", round(avg(v.mileage_km), 6) AS "平均走行距離" {_FROM_STOCK} GROUP BY 1""",
)
def mileage_band(spark, t):
    """Mileage in four bands."""
    out = KPI_INVENTORY.query(spark, ["走行距離区分"], ["在庫台数", "平均走行距離"], tables=t)
    return rounded(out, {"平均走行距離": RATIO})


@query(
    "kpi_inventory_totals",
    _STOCK
    + f"""
SELECT s.format AS "店舗業態", v.body_type AS "ボディタイプ",
  round(sum(v.listing_price), 4) AS "販売予定価格合計", round(sum(v.purchase_price), 4) AS "仕入価格合計"
{_FROM_STOCK} GROUP BY 1, 2""",
)
def inventory_totals(spark, t):
    """Sums of listing and purchase prices."""
    out = KPI_INVENTORY.query(
        spark, ["店舗業態", "ボディタイプ"], ["販売予定価格合計", "仕入価格合計"], tables=t
    )
    return rounded(out, {"販売予定価格合計": MONEY, "仕入価格合計": MONEY})


@query(
    "kpi_inventory_days",
    with_tables("sl_vehicles")
    + f"""
SELECT body_type AS "ボディタイプ", round(avg({TODAY} - stocked_date), 6) AS "平均在庫日数"
FROM sl_vehicles WHERE status = '在庫中' GROUP BY 1""",
)
def inventory_days(spark, t):
    """Days in stock of what is in stock, by body type."""
    out = KPI_INVENTORY.query(
        spark, ["body type"], ["days in stock"], where="source.status = '在庫中'", tables=t, as_of=AS_OF
    )
    return rounded(out, {"平均在庫日数": 6})


@query(
    "kpi_where_labels",
    with_tables("sl_contracts", "sl_stores")
    + """
SELECT CAST(date_trunc('month', contract_date) AS DATE) AS "契約年月", count(*) AS "契約件数"
FROM sl_contracts c LEFT JOIN sl_stores s ON c.store_id = s.store_id
WHERE date_trunc('month', contract_date) >= DATE '2001-03-01' AND date_trunc('month', contract_date) < DATE '2001-07-01'
  AND prefecture <> 'FRANCE' GROUP BY 1""",
)
def month_label(spark, t):
    """Contracts of a span of months, filtered by labels instead of names."""
    where = "`contract month` >= DATE'2001-03-01' AND `月` < DATE'2001-07-01' AND `prefecture` <> 'FRANCE'"
    return KPI_SALES.query(spark, ["month"], ["deals"], where=where, tables=t)


@query(
    "kpi_inventory_averages",
    with_tables("sl_vehicles")
    + """
SELECT maker AS "メーカー", round(avg(listing_price), 6) AS "平均販売予定価格",
  round(avg(mileage_km), 6) AS "平均走行距離", round(avg(model_year), 6) AS "平均年式"
FROM sl_vehicles GROUP BY 1""",
)
def inventory_averages(spark, t):
    """Average price, mileage and model year."""
    names = ["平均販売予定価格", "平均走行距離", "平均年式"]
    out = KPI_INVENTORY.query(spark, ["メーカー"], names, tables=t)
    return rounded(out, dict.fromkeys(names, RATIO))


@query(
    "kpi_inquiry_channel",
    with_tables("sl_inquiries")
    + """
SELECT channel AS "来店チャネル", count(*) AS "商談件数",
  count(*) FILTER (WHERE status = '成約') AS "成約商談数",
  round(count(*) FILTER (WHERE status = '成約') / nullif(count(*), 0), 6) AS "成約率"
FROM sl_inquiries GROUP BY 1""",
)
def inquiry_channel(spark, t):
    """Conversion rate by channel, best first."""
    out = KPI_INQUIRY.query(
        spark,
        ["来店チャネル"],
        ["商談件数", "成約商談数", "成約率"],
        order_by=[("成約率", "desc")],
        tables=t,
    )
    return rounded(out, {"成約率": RATIO})


@query(
    "kpi_inquiry_daily",
    with_tables("sl_inquiries")
    + """
SELECT inquiry_date AS "商談日", count(*) AS "商談件数",
  count(DISTINCT customer_id) AS "ユニーク顧客数" FROM sl_inquiries GROUP BY 1""",
)
def inquiry_daily(spark, t):
    """The monthly view at daily grain."""
    return KPI_INQUIRY.query(spark, ["商談日"], ["商談件数", "ユニーク顧客数"], tables=t)


@query(
    "kpi_inquiry_outcomes",
    _LEADS
    + """
SELECT s.format AS "店舗業態", count(*) FILTER (WHERE i.status = '成約') AS "成約商談数",
  count(*) FILTER (WHERE i.status = '失注') AS "失注商談数",
  count(*) FILTER (WHERE i.status = '進行中') AS "進行中商談数"
FROM sl_inquiries i LEFT JOIN sl_stores s ON i.store_id = s.store_id GROUP BY 1""",
)
def inquiry_outcomes(spark, t):
    """One fact split into won, lost and open."""
    view = KPI_INQUIRY.extend(
        Measure("進行中商談数", "COUNT(1) FILTER (WHERE source.status = '進行中')")
    )
    names = ["成約商談数", "失注商談数", "進行中商談数"]
    return view.query(spark, ["店舗業態"], names, tables=t)


@query(
    "kpi_formatted",
    with_tables("sl_contracts", "sl_stores")
    + """
SELECT strftime(CAST(date_trunc('month', c.contract_date) AS DATE), '%Y-%-m-%-d') AS "契約年月",
  s.format AS "店舗業態", format('{:,}', count(*)) AS "契約件数",
  format('{:,.0f}', sum(c.actual_price)) AS "売上合計",
  format('{:,.1f}', sum(c.gross_profit) / nullif(sum(c.actual_price), 0) * 100) || '%' AS "加重平均粗利率"
FROM sl_contracts c LEFT JOIN sl_stores s ON c.store_id = s.store_id GROUP BY c.contract_date IS NULL,
  date_trunc('month', c.contract_date), s.format""",
)
def formatted(spark, t):
    """Dates, grouped digits and percentages as display text, sorted on raw values."""
    return KPI_SALES.query(
        spark,
        ["契約年月", "店舗業態"],
        ["契約件数", "売上合計", "加重平均粗利率"],
        order_by=["契約年月", "店舗業態"],
        tables=t,
        formatted=True,
    )


@query(
    "kpi_customer",
    with_tables("sl_customers", "sl_inquiries", "sl_contracts")
    + ", "
    + gold.RM_SEGMENT_SQL
    + """
SELECT r.rm_segment AS "RMセグメント", c.segment AS "市場区分", count(*) AS "顧客数",
  round(sum(r.total_value) / nullif(sum(r.n_contracts), 0), 2) AS "平均購入単価"
FROM rm r LEFT JOIN sl_customers c ON r.customer_id = c.customer_id GROUP BY 1, 2""",
)
def customer(spark, t):
    """Customers and mean purchase value by recency / value segment."""
    segments = gold.rm_segment(t["sl_customers"], t["sl_inquiries"], t["sl_contracts"], AS_OF)
    tables = {"gd_customer_rm_segment": segments, "sl_customers": t["sl_customers"]}
    out = KPI_CUSTOMER.query(spark, ["RMセグメント", "市場区分"], ["顧客数", "平均購入単価"], tables=tables)
    return rounded(out, {"平均購入単価": MEAN})


@query(
    "kpi_from_summary",
    with_tables("sl_contracts", "sl_stores")
    + """
SELECT CAST(date_trunc('month', c.contract_date) AS DATE) AS "契約年月", s.format AS "店舗業態",
  count(*) AS "契約件数", round(sum(c.gross_profit) / nullif(sum(c.actual_price), 0), 6) AS "加重平均粗利率",
  round(avg(c.actual_price), 2) AS "平均販売価格", count(DISTINCT c.customer_id) AS "ユニーク顧客数"
FROM sl_contracts c LEFT JOIN sl_stores s ON c.store_id = s.store_id
WHERE c.contract_date >= DATE '1997-01-01' GROUP BY 1, 2""",
)
def from_summary(spark, t):
    """Months and distinct customers from a summary stored by day, store format and customer."""
    measures = ["契約件数", "加重平均粗利率", "平均販売価格", "ユニーク顧客数"]
    path = f"{working_folder(spark, 'summaries')}/sales_by_day"
    daily = build_summary(spark, KPI_SALES, path, ["契約日", "店舗業態"], measures, tables=t)
    out = query_from_summaries(
        spark, KPI_SALES, [daily], ["契約年月", "店舗業態"], measures, where="`契約年月` >= DATE'1997-01-01'", tables=t
    )
    return rounded(out, {"加重平均粗利率": RATIO, "平均販売価格": MEAN})
