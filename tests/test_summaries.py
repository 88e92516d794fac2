from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import day, plan, rows
from forecourt.plans import expressions as ex
from forecourt.plans.spec import Measure
from forecourt.plans.summaries import build_summary, query_from_summaries
from forecourt.plans.views import KPI_INQUIRY, KPI_INVENTORY, KPI_SALES
from forecourt.session import working_folder

ALL = [m.name for m in KPI_SALES.measures if m.name != "認定中古車販売比率"]
DIMS = ["契約日", "店舗業態", "都道府県"]


@pytest.fixture(scope="module")
def stored(spark, business):
    folder = working_folder(spark, "summaries")
    contracts = business["sl_contracts"]
    contracts.write.parquet(f"{folder}/facts-of-contracts")
    tables = {**business, "sl_contracts": spark.read.parquet(f"{folder}/facts-of-contracts")}
    fine = build_summary(spark, KPI_SALES, f"{folder}/summary-by-day", DIMS, ALL, tables)
    coarse = build_summary(spark, KPI_SALES, f"{folder}/summary-by-format", ["店舗業態"], ["契約件数", "売上合計"], tables)
    return tables, [fine, coarse]


def both(spark, stored, *args, **options):
    tables, summaries = stored
    direct = KPI_SALES.query(spark, *args, tables=tables, **options)
    return direct, query_from_summaries(spark, KPI_SALES, summaries, *args, tables=tables, **options)


def close(df):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.collect()), key=repr)


@pytest.mark.parametrize(
    ("dims", "options"),
    [
        (["契約年月", "店舗業態"], {}),
        (["month"], {"where": "`都道府県` = 'Tokyo'"}),
        (["契約日"], {"where": "`月` >= DATE'2001-07-01' AND `region` IS NOT NULL"}),
        ([], {}),
        ([], {"where": "`契約年月` = DATE'1990-01-01'"}),
        (["都道府県"], {"order_by": [("revenue", "desc")], "limit": 2}),
    ],
)
def test_same_rows_without_reading_the_fact(spark, stored, dims, options):
    direct, answered = both(spark, stored, dims, ALL, **options)
    assert close(answered) == close(direct)
    assert [(f.name, f.dataType, f.metadata) for f in answered.schema] == [(f.name, f.dataType, f.metadata) for f in direct.schema]
    assert "facts-of-contracts" in plan(direct) and "facts-of-contracts" not in plan(answered)


def test_month_filter_reaches_the_summary(spark, stored):
    text = plan(both(spark, stored, ["契約年月"], ["契約件数"], where="`契約年月` >= DATE'2001-07-01'")[1])
    assert "GreaterThanOrEqual" in text.split("PushedFilters")[1].splitlines()[0]


def test_the_smallest_fitting_summary_answers(spark, stored):
    text = plan(both(spark, stored, ["店舗業態"], ["契約件数"])[1])
    assert "summary-by-format" in text and "summary-by-day" not in text
    text = plan(both(spark, stored, ["店舗業態"], ["ユニーク顧客数"])[1])
    assert "summary-by-day" in text


@pytest.mark.parametrize(
    ("dims", "measures", "where"),
    [
        (["メーカー"], ["契約件数"], None),
        (["契約年月"], ["認定中古車販売比率"], None),
        (["契約年月"], ["契約件数"], "`メーカー` = 'M1'"),
        (["契約年月"], ["契約件数"], lambda: F.col("店舗業態") == "plaza"),
        (["契約年月"], ["契約件数"], "source.actual_price > 60"),
    ],
)
def test_what_is_not_stored_comes_from_the_fact(spark, stored, dims, measures, where):
    where = where() if callable(where) else where
    direct, answered = both(spark, stored, dims, measures, where=where)
    assert "facts-of-contracts" in plan(answered) and close(answered) == close(direct)


def test_a_summary_of_another_day_does_not_answer(spark, business):
    path, then, now = f"{working_folder(spark, 'summaries')}/stock-of-a-day", day("2001-08-01"), day("2001-08-02")
    kept = build_summary(spark, KPI_INVENTORY, path, ["店舗業態"], ["平均在庫日数", "認定中古車比率"], business, as_of=then)
    for on, used in ((then, True), (now, False)):
        out = query_from_summaries(spark, KPI_INVENTORY, [kept], ["店舗業態"], ["平均在庫日数"], tables=business, as_of=on)
        assert ("stock-of-a-day" in plan(out)) is used
        assert close(out) == close(KPI_INVENTORY.query(spark, ["店舗業態"], ["平均在庫日数"], tables=business, as_of=on))


def test_filtered_parts_and_unknown_aggregates(spark, business):
    view = KPI_INQUIRY.extend(
        Measure("open", "COUNT(1) FILTER (WHERE source.status = '進行中')"),
        Measure("last", "max(source.inquiry_date)"),
        Measure("middle", "median(source.customer_id) + sum(source.customer_id)"),
        Measure("pairs", "count(DISTINCT source.customer_id, source.store_id)"),
    )
    path = f"{working_folder(spark, 'summaries')}/leads"
    kept = build_summary(spark, view, path, ["月"], ["open", "last", "成約率"], business)
    for dims in ([], ["月"]):
        out = query_from_summaries(spark, view, [kept], dims, ["open", "last", "成約率"], tables=business)
        assert "/leads" in plan(out) and close(out) == close(view.query(spark, dims, ["open", "last", "成約率"], tables=business))
    for name in ("middle", "pairs"):
        with pytest.raises(ValueError, match="cannot be put together"):
            build_summary(spark, view, path, ["月"], [name], business)


def test_decimal_sums_stay_with_the_fact(spark, business):
    exact = business["sl_contracts"].withColumn("actual_price", F.col("actual_price").cast("decimal(12,2)"))
    tables = {**business, "sl_contracts": exact}
    kept = build_summary(spark, KPI_SALES, f"{working_folder(spark, 'summaries')}/exact-sums", ["店舗業態"], ["売上合計"], tables)
    out = query_from_summaries(spark, KPI_SALES, [kept], ["店舗業態"], ["売上合計"], tables=tables)
    assert "exact-sums" not in plan(out)


def test_aggregate_calls_are_found_outside_literals():
    text = "sum(if(a.b = 'count(', 1, (2))) / nullif(count(1) FILTER (WHERE a.c = ')'), 0) + `max(`"
    assert [(c.function, c.argument, c.filter) for c in ex.aggregates(text)] == [
        ("sum", "if(a.b = 'count(', 1, (2))", None),
        ("count", "1", "a.c = ')'"),
    ]
    assert ex.split_arguments("f(a, b), ',', c") == ["f(a, b)", "','", "c"]
