from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import day, plan, rows
from forecourt.plans import expressions as ex
from forecourt.plans.metric_view import MetricView, list_views
from forecourt.plans.spec import Dimension, Format, Join, Measure
from forecourt.plans.views import BUILT_IN, KPI_INQUIRY, KPI_INVENTORY, KPI_SALES
from forecourt.sources.bindings import LogicalTables

SPEC = {
    "version": "1.1",
    "source": "shop.main.sl_contracts",
    "joins": [{"name": "store", "source": "shop.main.sl_stores", "on": "source.store_id = store.store_id"}],
    "dimensions": [
        {
            "name": "month",
            "expr": "DATE_TRUNC('MONTH', source.contract_date)",
            "synonyms": ["契約年月"],
            "format": {"type": "date", "date_format": "year_month_day"},
        },
        {"name": "area", "expr": "store.prefecture"},
    ],
    "measures": [
        {"name": "deals", "expr": "COUNT(1)"},
        {"name": "sales", "expr": "SUM(source.actual_price)"},
        {
            "name": "per deal",
            "expr": "MEASURE(`sales`) / NULLIF(MEASURE(deals), 0)",
            "display_name": "Sales per deal",
            "format": {"type": "number", "decimal_places": {"type": "exact", "places": 1}},
        },
    ],
}


def changed(**parts):
    return {**SPEC, **parts}


# -- specification ---------------------------------------------------------


@pytest.mark.parametrize("field", ["version", "source", "dimensions", "measures"])
def test_missing_field(field):
    with pytest.raises(ValueError, match=field):
        MetricView.from_dict({k: v for k, v in SPEC.items() if k != field})


@pytest.mark.parametrize(
    "bad",
    [
        changed(version="1.0"),
        changed(dimensions=[{"name": "deals", "expr": "source.store_id"}]),
        changed(dimensions=[{"name": "source", "expr": "source.store_id"}]),
        changed(dimensions=[{"name": "store", "expr": "source.store_id"}]),
        changed(dimensions=[{"name": "x"}]),
        changed(joins=[{"name": "source", "source": "t", "on": "1 = 1"}]),
        changed(joins=[{"name": "store", "source": "t"}]),
        changed(measures=[{"name": "a", "expr": "MEASURE(`gone`)"}]),
        changed(measures=[{"name": "a", "expr": "MEASURE(`b`)"}, {"name": "b", "expr": "MEASURE(`a`)"}]),
        changed(measures=[{"name": "a", "expr": "1", "format": {"type": "money"}}]),
    ],
)
def test_refused_specifications(bad):
    with pytest.raises(ValueError):
        MetricView.from_dict(bad)


def test_yaml_gives_the_same_view():
    yaml = pytest.importorskip("yaml")
    text = yaml.safe_dump(SPEC, allow_unicode=True).replace("'on':", "on:")
    assert MetricView.from_yaml(text, "v") == MetricView.from_dict(SPEC, "v")


def test_built_in_views_have_the_declared_sizes():
    sizes = {v.name: (len(v.joins), len(v.dimensions), len(v.measures)) for v in BUILT_IN}
    assert sizes["kpi_sales"] == (2, 10, 8)
    assert sizes["kpi_inventory"] == (1, 9, 9)
    assert sizes["kpi_inquiry"] == (1, 7, 5)


def test_views_are_listed_by_pattern():
    assert [v.name for v in list_views(BUILT_IN, "kpi_in*")] == ["kpi_inventory", "kpi_inquiry"]


# -- expressions -----------------------------------------------------------


def test_measures_expand_outside_literals_only():
    stored = {"a": "SUM(x)", "b": "MEASURE(`a`) + 1"}
    got = ex.expand_measures("MEASURE(b) || 'MEASURE(`a`)' || measure( `a` )", stored.__getitem__)
    assert got == "((SUM(x)) + 1) || 'MEASURE(`a`)' || (SUM(x))"


def test_today_is_pinned_outside_literals_and_names():
    got = ex.pin_today("year(current_date()) + `current_date` + t.current_date + 'current_date()'", day("2001-08-01"))
    assert got == "year(DATE'2001-08-01') + `current_date` + t.current_date + 'current_date()'"
    assert ex.pin_today("current_date", None) == "current_date"


def test_qualified_columns():
    found = ex.qualified_columns("store.a = `source`.`b c` AND 'store.z' = Vehicle.d.e")
    assert found == {("store", "a"), ("source", "b c"), ("vehicle", "d")}


# -- names -----------------------------------------------------------------


def test_names_resolve_by_synonym_and_display_name(spark, business):
    view = MetricView.from_dict(SPEC)
    out = view.query(spark, ["契約年月"], ["SALES PER DEAL"], tables=business)
    assert out.columns == ["month", "per deal"]


@pytest.mark.parametrize("name", ["*", "unknown"])
def test_refused_names_list_the_valid_ones(spark, business, name):
    with pytest.raises(ValueError, match="契約年月"):
        KPI_SALES.query(spark, [name], ["契約件数"], tables=business)
    with pytest.raises(ValueError, match="売上合計"):
        KPI_SALES.query(spark, ["店舗名"], [name], tables=business)


def test_ambiguous_synonym(spark, business):
    view = KPI_SALES.extend(Dimension("x", "source.store_id", ("maker",)))
    with pytest.raises(ValueError, match="ambiguous"):
        view.query(spark, ["MAKER"], ["契約件数"], tables=business)


def test_nothing_asked(spark, business):
    with pytest.raises(ValueError):
        KPI_SALES.query(spark, tables=business)


def test_wrong_joined_column_fails(spark, business):
    view = KPI_SALES.extend(Dimension("bad", "vehicle.is_certified"))
    with pytest.raises(AnalysisException, match="is_certified"):
        view.query(spark, ["bad"], ["契約件数"], tables=business)


def test_missing_source_table(spark):
    with pytest.raises(AnalysisException):
        KPI_SALES.query(spark, ["店舗名"], ["契約件数"], tables={})


def test_tables_come_from_the_session_if_not_given(spark, business):
    for name in ("sl_contracts", "sl_stores"):
        business[name].createOrReplaceTempView(name)
    try:
        out = KPI_SALES.query(spark, ["type"], ["契約件数"])
        assert rows(out) == [("plaza", 2), ("import", 1), (None, 1)]
    finally:
        for name in ("sl_contracts", "sl_stores"):
            spark.catalog.dropTempView(name)


def test_metadata_is_on_the_columns(spark, business):
    out = KPI_SALES.query(spark, ["店舗名"], ["売上合計"], tables=business)
    assert out.schema["売上合計"].metadata["synonyms"][0] == "売上"
    assert out.schema["売上合計"].metadata["format"] == "number"
    assert out.schema["売上合計"].metadata["decimal_places"] == 0


# -- results ---------------------------------------------------------------


def test_unmatched_rows_stay_with_null_dimensions(spark, business):
    out = KPI_SALES.query(spark, ["都道府県"], ["契約件数", "売上合計"], tables=business)
    assert rows(out) == [("Osaka", 1, 0.0), ("Tokyo", 2, 400.0), (None, 1, 50.0)]


def test_null_falls_into_the_last_band(spark, business):
    args = dict(tables=business, as_of=day("2001-08-01"))
    assert rows(KPI_INVENTORY.query(spark, ["年式区分"], ["在庫台数"], **args)) == [
        ("10年超", 1),
        ("3年以内", 1),
        ("4-7年", 1),
    ]
    assert rows(KPI_INVENTORY.query(spark, ["走行距離区分"], ["在庫台数"], **args)) == [
        ("10万km超", 1),
        ("3-6万km", 1),
        ("〜3万km", 1),
    ]
    assert rows(KPI_INVENTORY.query(spark, ["認定中古車"], ["在庫台数"], **args)) == [
        ("認定", 1),
        ("非認定", 2),
    ]


def test_zero_denominator_gives_null(spark, business):
    out = KPI_SALES.query(spark, ["店舗名"], ["加重平均粗利率"], where="`店舗名` = 'South'", tables=business)
    assert rows(out) == [("South", None)]


def test_weighted_ratio_is_a_ratio_of_sums(spark, business):
    out = KPI_SALES.query(spark, [], ["加重平均粗利率", "顧客あたり売上", "認定中古車販売比率"], tables=business)
    assert rows(out) == [(50.0 / 450.0, 225.0, 0.25)]


def test_no_dimensions_on_empty_input_is_one_row(spark, business):
    empty = {**business, "sl_contracts": business["sl_contracts"].limit(0)}
    out = KPI_SALES.query(spark, [], ["契約件数", "売上合計", "加重平均粗利率"], tables=empty)
    assert rows(out) == [(0, None, None)]
    assert rows(KPI_SALES.query(spark, ["店舗名"], ["契約件数"], tables=empty)) == []


def test_no_measures_gives_distinct_dimensions(spark, business):
    out = KPI_SALES.query(spark, ["店舗業態"], tables=business)
    assert rows(out) == [("import",), ("plaza",), (None,)]


def test_filter_as_text_and_as_column(spark, business):
    text = KPI_SALES.query(spark, ["メーカー"], ["契約件数"], where="`契約日` >= DATE'2001-07-01'", tables=business)
    column = KPI_SALES.query(spark, ["メーカー"], ["契約件数"], where=F.col("契約日") >= "2001-07-01", tables=business)
    assert rows(text) == rows(column) == [("M1", 1), ("M2", 1)]


def test_filter_may_name_a_source_column(spark, business):
    out = KPI_SALES.query(spark, [], ["契約件数"], where="source.actual_price > 60", tables=business)
    assert rows(out) == [(2,)]


def test_truncated_timestamp_becomes_a_date(spark, business):
    out = MetricView.from_dict(SPEC).query(spark, ["month"], ["deals"], tables=business)
    assert dict(out.dtypes)["month"] == "date"
    assert rows(out) == [(day("2001-06-01"), 2), (day("2001-07-01"), 2)]


def test_order_limit_and_ties(spark, business):
    out = KPI_SALES.query(spark, ["店舗名"], ["契約件数"], order_by=[("契約件数", "desc")], limit=2, tables=business)
    assert [tuple(r) for r in out.collect()] == [("North", 2), (None, 1)]
    with pytest.raises(ValueError):
        KPI_SALES.query(spark, ["店舗名"], ["契約件数"], order_by=[("契約件数", "up")], tables=business)
    with pytest.raises(ValueError):
        KPI_SALES.query(spark, ["店舗名"], ["契約件数"], order_by=["売上合計"], tables=business)


def test_formats_do_not_change_the_order(spark, business):
    view = MetricView(
        "v",
        "sl_contracts",
        (Dimension("d", "source.contract_date", format=Format("date")),),
        (
            Measure("n", "sum(source.actual_price) * 1000", format=Format("number", 1)),
            Measure("p", "sum(source.gross_profit) / nullif(sum(source.actual_price), 0)", format=Format("percentage", 1)),
        ),
    )
    out = view.query(spark, ["d"], ["n", "p"], order_by=[("n", "desc")], tables=business, formatted=True)
    assert [tuple(r) for r in out.collect()] == [
        ("2001-7-31", "300,000.0", "10.0%"),
        ("2001-7-5", "100,000.0", "20.0%"),
        ("2001-6-11", "50,000.0", "10.0%"),
        ("2001-6-10", "0.0", None),
    ]


def test_validate_reports_duplicate_keys(spark, business):
    doubled = {**business, "sl_stores": business["sl_stores"].union(business["sl_stores"].filter("store_id = 2"))}
    assert rows(KPI_SALES.validate(spark, doubled)) == [("store", '{"store_id":2}', 2)]
    assert rows(KPI_SALES.validate(spark, business)) == []


# -- pruning and agreement with plain SQL ----------------------------------


def test_needed_joins():
    assert KPI_SALES.needed_joins(["source.actual_price"]) == []
    assert [j.name for j in KPI_SALES.needed_joins(["STORE.format"])] == ["store"]
    chained = MetricView(
        "v",
        "f",
        (Dimension("d", "region.name"),),
        (Measure("n", "count(1)"),),
        (Join("store", "s", "source.k = store.k"), Join("region", "r", "store.rk = region.k")),
    )
    assert [j.name for j in chained.needed_joins(["region.name"])] == ["store", "region"]


def test_pruned_equals_unpruned(spark, business):
    ask = dict(dims=["都道府県"], measures=["契約件数", "売上合計"], tables=business)
    assert rows(KPI_SALES.query(spark, **ask)) == rows(KPI_SALES.query(spark, prune=False, **ask))


def test_unneeded_tables_and_columns_are_not_read(spark, small):
    t = LogicalTables(spark, small)
    text = plan(KPI_INQUIRY.query(spark, ["来店チャネル"], ["商談件数"], tables=t))
    assert text.count("ReadSchema") == 1
    assert "ReadSchema: struct<o_orderpriority:string>" in text
    assert "Join" not in text


def test_date_filter_reaches_the_scan(spark, small):
    t = LogicalTables(spark, small)
    text = plan(KPI_INQUIRY.query(spark, ["商談ステータス"], ["商談件数"], where="`商談日` >= DATE'2000-01-01'", tables=t))
    assert "GreaterThanOrEqual(o_orderdate,2000-01-01" in text


def test_small_dimension_from_joins_is_broadcast(spark, small):
    t = LogicalTables(spark, small)
    ask = dict(dims=["都道府県"], measures=["契約件数"], tables=t)
    assert "SortMergeJoin" not in plan(KPI_SALES.query(spark, **ask))
    assert "SortMergeJoin" in plan(KPI_SALES.query(spark, broadcast_bytes=0, **ask))


def same(a, b):
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_sales_equals_hand_written_sql(spark, small):
    t = LogicalTables(spark, small)
    got = KPI_SALES.query(
        spark, ["契約年月", "店舗業態"], ["契約件数", "売上合計", "加重平均粗利率"], tables=t, formatted=True
    )
    want = spark.sql(
        """SELECT date_format(trunc(c.contract_date, 'MM'), 'yyyy-M-d') AS m, s.format AS f,
             format_number(count(1), 0) AS n, format_number(sum(c.actual_price), 0) AS s,
             format_number(sum(c.gross_profit) / nullif(sum(c.actual_price), 0) * 100, 1) || '%' AS r
           FROM {c} c LEFT JOIN {s} s ON c.store_id = s.store_id
           GROUP BY trunc(c.contract_date, 'MM'), s.format""",
        c=t["sl_contracts"],
        s=t["sl_stores"],
    )
    same(got.toDF(*want.columns), want)


def test_inquiry_equals_hand_written_sql(spark, small):
    t = LogicalTables(spark, small)
    got = KPI_INQUIRY.query(spark, ["来店チャネル"], ["商談件数", "成約商談数", "成約率"], tables=t)
    want = spark.sql(
        """SELECT channel, count(1) AS n, count(1) FILTER (WHERE status = '成約') AS won,
             count(1) FILTER (WHERE status = '成約') / nullif(count(1), 0) AS rate
           FROM {i} GROUP BY channel""",
        i=t["sl_inquiries"],
    )
    same(got.toDF(*want.columns), want)


def test_parts_add_up_to_the_total(spark, small):
    t = LogicalTables(spark, small)
    total = KPI_SALES.query(spark, [], ["契約件数"], tables=t).first()[0]
    for d in KPI_SALES.dimensions:
        parts = KPI_SALES.query(spark, [d.name], ["契約件数"], tables=t).agg(F.sum("契約件数")).first()[0]
        assert parts == total, d.name


@pytest.mark.parametrize(
    ("where", "pushed"),
    [
        ("`契約年月` = DATE'2001-07-01'", True),
        ("`month` >= DATE'2001-06-01' and `契約年月` < DATE'2001-07-01'", True),
        ("`契約年月` > DATE'2001-06-15' AND `メーカー` <> 'a'", True),
        ("`契約年月` <= DATE'2001-06-15'", True),
        ("`契約年月` = DATE'2001-07-01' OR `契約年月` = DATE'2001-06-01'", False),
        ("NOT (`契約年月` = DATE'2001-07-01')", False),
    ],
)
def test_month_filters_reach_the_scan_and_change_nothing(spark, small, where, pushed):
    t = LogicalTables(spark, small)
    ask = dict(dims=["契約年月"], measures=["契約件数"], tables=t)
    got = KPI_SALES.query(spark, where=where, **ask)
    name = where.replace("month", "契約年月")
    want = KPI_SALES.query(spark, where=F.expr(name), **ask)
    assert rows(got) == rows(want) and got.count()
    scans = [line for line in plan(got).splitlines() if "PushedFilters" in line]
    assert any("(o_orderdate," in line for line in scans) == pushed


def test_labels_in_filters(spark, business):
    by_label = KPI_SALES.query(spark, ["店舗名"], ["契約件数"], where="`prefecture` = 'Tokyo'", tables=business)
    by_name = KPI_SALES.query(spark, ["店舗名"], ["契約件数"], where="`都道府県` = 'Tokyo'", tables=business)
    assert rows(by_label) == rows(by_name) and by_name.count()
    with pytest.raises(Exception, match="nowhere"):
        KPI_SALES.query(spark, ["店舗名"], ["契約件数"], where="`nowhere` = 1", tables=business).collect()
