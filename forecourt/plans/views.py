"""The built-in metric views.

Names, synonyms, labels and number formats are fixed values: callers address
dimensions and measures by them.
"""

from __future__ import annotations

from forecourt.functions.bands import band, month_start, share
from forecourt.plans.metric_view import MetricView
from forecourt.plans.spec import Dimension, Format, Join, Measure

_DATE = Format("date")
_WHOLE = Format("number", 0)
_TENTHS = Format("number", 1)
_PERCENT = Format("percentage", 1)

_STORE = Join("store", "sl_stores", "source.store_id = store.store_id")
_VEHICLE = Join("vehicle", "sl_vehicles", "source.vehicle_id = vehicle.vehicle_id")
_CUSTOMER = Join("customer", "sl_customers", "source.customer_id = customer.customer_id")


def _store_dimensions(*more_format_synonyms: str) -> tuple[Dimension, ...]:
    return (
        Dimension("店舗名", "store.store_name", ("店名", "store", "store name")),
        Dimension("都道府県", "store.prefecture", ("県", "エリア", "prefecture", "region")),
        Dimension(
            "店舗業態", "store.format", ("業態", "format", "store format", *more_format_synonyms)
        ),
    )


def _vehicle_dimensions(alias: str) -> tuple[Dimension, ...]:
    """Vehicle attributes, whether the vehicle is the fact or a joined table."""
    age = f"(year(current_date()) - {alias}.model_year)"
    return (
        Dimension("ボディタイプ", f"{alias}.body_type", ("車種カテゴリ", "body type", "vehicle type")),
        Dimension("メーカー", f"{alias}.maker", ("ブランド", "maker", "manufacturer", "brand")),
        Dimension(
            "年式区分",
            band(age, [(3, "3年以内"), (7, "4-7年"), (10, "8-10年")], "10年超"),
            ("年式バケット", "year bucket", "age bucket"),
        ),
        Dimension(
            "認定中古車",
            f"if({alias}.certified, '認定', '非認定')",
            ("認定フラグ", "certified", "certification"),
        ),
        Dimension("修復歴", f"{alias}.repair_history", ("事故歴", "repair history", "accident")),
    )


KPI_SALES = MetricView(
    name="kpi_sales",
    source="sl_contracts",
    comment="Contracts with store and vehicle attributes: units, sales, gross profit.",
    joins=(_STORE, _VEHICLE),
    dimensions=(
        Dimension(
            "契約年月",
            month_start("source.contract_date"),
            ("月", "年月", "contract month", "month"),
            _DATE,
        ),
        Dimension("契約日", "source.contract_date", ("日付", "contract date", "date"), _DATE),
        *_store_dimensions("type"),
        *_vehicle_dimensions("vehicle"),
    ),
    measures=(
        Measure(
            "契約件数", "count(1)", ("販売台数", "成約数", "contracts", "deals", "units sold"), _WHOLE
        ),
        Measure(
            "売上合計",
            "sum(source.actual_price)",
            ("売上", "総売上", "total sales", "revenue"),
            _WHOLE,
        ),
        Measure(
            "粗利合計",
            "sum(source.gross_profit)",
            ("粗利", "total gross profit", "gross profit"),
            _WHOLE,
        ),
        Measure(
            "平均販売価格",
            "avg(source.actual_price)",
            ("平均単価", "average sale price", "avg price"),
            _WHOLE,
        ),
        Measure(
            "加重平均粗利率",
            "measure(`粗利合計`) / nullif(measure(`売上合計`), 0)",
            ("粗利率", "gross margin", "margin"),
            _PERCENT,
            comment="Ratio of sums, so large deals weigh more; not a mean of row ratios.",
        ),
        Measure(
            "ユニーク顧客数",
            "count(DISTINCT source.customer_id)",
            ("顧客数", "unique customers", "customer count"),
            _WHOLE,
        ),
        Measure(
            "顧客あたり売上",
            "measure(`売上合計`) / nullif(measure(`ユニーク顧客数`), 0)",
            ("客単価", "sales per customer", "ARPU"),
            _WHOLE,
        ),
        Measure(
            "認定中古車販売比率",
            share("vehicle.certified"),
            ("認定比率", "certified ratio", "certification rate"),
            _PERCENT,
        ),
    ),
)

KPI_INVENTORY = MetricView(
    name="kpi_inventory",
    source="sl_vehicles",
    comment="Vehicles with store attributes. Every row counts; filter by status at query time.",
    joins=(_STORE,),
    dimensions=(
        *_store_dimensions(),
        *_vehicle_dimensions("source"),
        Dimension(
            "走行距離区分",
            band(
                "source.mileage_km",
                [(30_000, "〜3万km"), (60_000, "3-6万km"), (100_000, "6-10万km")],
                "10万km超",
                op="<",
            ),
            ("走行バケット", "mileage bucket"),
        ),
    ),
    measures=(
        Measure("在庫台数", "count(1)", ("在庫数", "inventory count", "stock"), _WHOLE),
        Measure(
            "販売予定価格合計",
            "sum(source.listing_price)",
            ("掲載価格合計", "total listing price"),
            _WHOLE,
        ),
        Measure(
            "仕入価格合計", "sum(source.purchase_price)", ("仕入合計", "total purchase price"), _WHOLE
        ),
        Measure(
            "平均販売予定価格",
            "avg(source.listing_price)",
            ("平均掲載価格", "average listing price"),
            _WHOLE,
        ),
        Measure(
            "平均走行距離",
            "avg(source.mileage_km)",
            ("平均ミレージ", "average mileage", "mileage"),
            _WHOLE,
        ),
        Measure(
            "平均年式", "avg(source.model_year)", ("平均モデルイヤー", "average model year"), _TENTHS
        ),
        Measure(
            "平均在庫日数",
            "avg(datediff(current_date(), source.stocked_date))",
            ("在庫日数", "days in stock", "average days in stock"),
            _TENTHS,
        ),
        Measure("認定中古車比率", share("source.certified"), ("認定比率", "certified ratio"), _PERCENT),
        Measure(
            "修復歴あり比率",
            share("source.repair_history = 'あり'"),
            ("事故歴比率", "repair history ratio"),
            _PERCENT,
        ),
    ),
)

KPI_INQUIRY = MetricView(
    name="kpi_inquiry",
    source="sl_inquiries",
    comment="Inquiries with store attributes: leads won and lost.",
    joins=(_STORE,),
    dimensions=(
        Dimension(
            "商談年月",
            month_start("source.inquiry_date"),
            ("月", "年月", "inquiry month", "month"),
            _DATE,
        ),
        Dimension("商談日", "source.inquiry_date", ("日付", "inquiry date", "date"), _DATE),
        *_store_dimensions(),
        Dimension("来店チャネル", "source.channel", ("チャネル", "channel", "inquiry channel")),
        Dimension("商談ステータス", "source.status", ("ステータス", "status", "deal status")),
    ),
    measures=(
        Measure("商談件数", "count(1)", ("来店数", "inquiries", "leads"), _WHOLE),
        Measure(
            "成約商談数",
            "count_if(source.status = '成約')",
            ("成約数", "closed inquiries", "deals won"),
            _WHOLE,
        ),
        Measure(
            "失注商談数",
            "count_if(source.status = '失注')",
            ("失注数", "lost inquiries", "deals lost"),
            _WHOLE,
        ),
        Measure(
            "成約率",
            "measure(`成約商談数`) / nullif(measure(`商談件数`), 0)",
            ("クロージングレート", "close rate", "win rate", "conversion rate"),
            _PERCENT,
        ),
        Measure(
            "ユニーク顧客数",
            "count(DISTINCT source.customer_id)",
            ("顧客数", "unique customers", "customer count"),
            _WHOLE,
        ),
    ),
)

KPI_CUSTOMER = MetricView(
    name="kpi_customer",
    source="gd_customer_rm_segment",
    comment="Customers by recency / value segment. Age and sex are not in the data; "
    "market segment and area stand in for them.",
    joins=(_CUSTOMER,),
    dimensions=(
        Dimension("RMセグメント", "source.rm_segment", ("セグメント", "rm segment", "segment")),
        Dimension("市場区分", "customer.segment", ("market segment",)),
        Dimension("居住エリア", "customer.area", ("エリア", "area")),
    ),
    measures=(
        Measure("顧客数", "count(1)", ("customers", "customer count"), _WHOLE),
        Measure(
            "平均購入単価",
            "sum(source.total_value) / nullif(sum(source.n_contracts), 0)",
            ("平均購入額", "average purchase value"),
            _WHOLE,
        ),
        Measure("累計取引額", "sum(source.total_value)", ("total value",), _WHOLE),
    ),
)

BUILT_IN = (KPI_SALES, KPI_INVENTORY, KPI_INQUIRY, KPI_CUSTOMER)
