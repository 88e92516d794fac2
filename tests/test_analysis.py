from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import day, plan, rows
from forecourt.operators import analysis
from forecourt.sources.bindings import LogicalTables

AS_OF = day("2001-08-01")


def test_months_before():
    assert analysis.months_before(AS_OF, 0) == AS_OF
    assert analysis.months_before(day("2001-03-15"), 3) == day("2000-12-01")
    assert analysis.months_before(day("2001-12-31"), 12) == day("2000-12-01")


def test_top_store_prev_month(business):
    assert rows(analysis.top_store_prev_month(business, AS_OF)) == [(1, 50.0, "North")]
    assert rows(analysis.top_store_prev_month(business, day("2000-01-01"))) == []


def test_top_store_may_be_unknown_to_the_master_but_not_missing(spark, business):
    contracts = spark.createDataFrame(
        [(day("2001-07-01"), 777, 9.0), (day("2001-07-02"), 1, 5.0), (day("2001-07-03"), None, 99.0)],
        "contract_date date, store_id long, gross_profit double",
    )
    assert rows(analysis.top_store_prev_month({**business, "sl_contracts": contracts}, AS_OF)) == [(777, 9.0, None)]


def test_store_ranking_has_ties_and_unknown_stores(spark, business):
    contracts = spark.createDataFrame(
        [(i, day("2001-07-01"), s, p) for i, s, p in [(1, 1, 5.0), (2, 3, 5.0), (3, 2, 1.0), (4, None, 9.0)]],
        "contract_id long, contract_date date, store_id long, gross_profit double",
    )
    out = analysis.store_ranking({**business, "sl_contracts": contracts})
    assert rows(out.select("store_id", "store_rank", "prefecture", "area_profit", "area_rank")) == [
        (None, 1, None, 9.0, 2),
        (1, 2, "Tokyo", 10.0, 1),
        (3, 2, "Tokyo", 10.0, 1),
        (2, 4, "Osaka", 1.0, 3),
    ]


def test_top_models_of_a_segment(business):
    assert rows(analysis.top3_segment(business, k=1)) == [("HOME", "a", 1, 1), ("WORK", "b", 1, 1)]


def test_falling_index(business):
    assert rows(analysis.falling_index_sales(business)) == [
        (day("2001-07-01"), "SUV", 12.0, -3.0, 1, 100.0)
    ]


def test_margin_by_repair(business):
    assert rows(analysis.margin_by_repair(business)) == [
        (1, 2, 0.1, 0.2),
        (2, 1, None, None),
        (None, 1, None, None),
    ]


def test_turnover_ignores_contracts_before_stocking(business):
    out = analysis.turnover_days(business, AS_OF)
    assert rows(out) == [("SUV", 1, 185.0, 2, (212 + 578) / 2), ("セダン", 2, (152 + 101) / 2, None, None)]


def test_aged_stock(business):
    out = analysis.aged_stock(business, AS_OF, min_days=212)
    assert rows(out) == [("SUV", "180-270", 1, 100.0, 212), ("SUV", "456+", 1, 300.0, 578)]
    assert rows(analysis.aged_stock(business, AS_OF, min_days=213)) == [("SUV", "456+", 1, 300.0, 578)]


def test_funnel_counts_each_inquiry_once(business):
    assert rows(analysis.funnel(business)) == [
        ("web", 1, 2, 1, 2, 3, 400.0, 1.0),
        ("shop", 2, 1, 0, 0, 0, 0.0, 0.0),
    ]


def test_store_decline_needs_full_history(spark):
    profits = [10.0, 10.0, 10.0, 7.0, 9.0]
    contracts = spark.createDataFrame(
        [(1, day(f"2001-0{i + 1}-10"), p) for i, p in enumerate(profits)],
        "store_id long, contract_date date, gross_profit double",
    )
    out = analysis.store_decline({"sl_contracts": contracts}, drop=0.3)
    assert [(r["month"], r["earlier_mean"]) for r in out.collect()] == [(day("2001-04-01"), 10.0)]


def test_store_decline_reports_stores_that_stop(spark):
    sold = [(1, f"2001-0{m}-10", 10.0) for m in range(1, 5)] + [(2, f"2001-0{m}-10", 10.0) for m in range(1, 7)]
    contracts = spark.createDataFrame(
        [(s, day(d), p) for s, d, p in sold] + [(None, day("2001-06-10"), 1.0), (1, None, 1.0)],
        "store_id long, contract_date date, gross_profit double",
    )
    out = analysis.store_decline({"sl_contracts": contracts}).filter("gross_profit = 0")
    assert [(r["store_id"], r["month"], r["change"]) for r in out.orderBy("month").collect()] == [
        (1, day("2001-05-01"), -1.0),
        (1, day("2001-06-01"), -1.0),
    ]


def test_correlation_counts_every_store(business):
    assert analysis.store_corr(business).first()["stores"] == 3


def test_change_goes_by_calendar_month(spark, business):
    contracts = spark.createDataFrame(
        [(day(d) if d else None, 10, p, 1.0) for d, p in [(None, 9.0), ("2001-03-01", 10.0), ("2001-05-01", 20.0), ("2001-06-01", 30.0)]],
        "contract_date date, vehicle_id long, actual_price double, gross_profit double",
    )
    out = analysis.trend({**business, "sl_contracts": contracts}).orderBy("month")
    assert [(r["month"].month, r["change"], r["three_month_mean"]) for r in out.collect()] == [
        (3, None, 10.0), (5, None, 15.0), (6, 0.5, 25.0)
    ]
    index = spark.createDataFrame(
        [(day(f"2001-0{m}-01"), "SUV", v) for m, v in [(3, 9.0), (5, 8.0), (6, 7.0)]] + [(None, "SUV", 10.0)],
        "date date, vehicle_category string, market_index double",
    )
    fell = analysis.falling_index_sales({**business, "sl_contracts": contracts, "sl_market_index": index})
    assert [(r["month"].month, r["index_change"]) for r in fell.collect()] == [(6, -1.0)]


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 6.0, 5.0)], "a double, b double, c double")
    got = df.agg(analysis.correlation("a", "b"), analysis.correlation("a", "c")).first()
    assert got[0] == pytest.approx(1.0) and got[1] is None


def test_heatmap_columns_are_fixed(business):
    out = analysis.heatmap(business, AS_OF, months=2)
    assert out.columns == ["store_id", "units_2001_06", "margin_2001_06", "units_2001_07", "margin_2001_07"]
    assert rows(out) == [(1, 0, None, 2, 0.125), (2, 1, None, 0, None), (None, 1, 0.1, 0, None)]


def test_composition_shares_add_up(business):
    out = analysis.composition(business).agg(F.sum("unit_share"), F.sum("sales_share")).first()
    assert tuple(out) == pytest.approx((1.0, 1.0))


def test_scatter_sample_is_repeatable_and_about_right(spark, small):
    t = LogicalTables(spark, small)
    whole = analysis.scatter(t)
    part = analysis.scatter(t, share=0.5)
    assert rows(part) == rows(analysis.scatter(t, share=0.5))
    assert part.exceptAll(whole).isEmpty()
    assert 0.3 < part.count() / whole.count() < 0.7


def test_segments(business):
    # 101 signed contracts in June; 102 never appeared
    assert rows(analysis.dormant(business, AS_OF).select("customer_id", "months_since")) == [(102, None)]
    assert rows(analysis.dormant(business, AS_OF, months=0).select("customer_id")) == [(101,), (102,)]
    assert rows(analysis.vip_churn(business, AS_OF)) == []
    assert rows(analysis.ltv(business, AS_OF)) == [
        ("HOME", 1, 1, 400.0, 400.0, 200.0),
        ("WORK", 2, 1, 50.0, 25.0, 25.0),
    ]


def test_margin_effects_add_up(spark, small):
    out = analysis.margin_drop(LogicalTables(spark, small), AS_OF)
    for r in out.collect():
        assert r["volume_effect"] + r["price_effect"] + r["margin_effect"] == pytest.approx(r["profit_change"])


def test_margin_drop_with_a_category_in_one_period_only(business):
    out = {r["body_type"]: r for r in analysis.margin_drop(business, AS_OF, months=1).collect()}
    assert out["SUV"]["units_before"] == 0 and out["SUV"]["profit_change"] == 20.0
    assert out[None]["units_after"] == 0 and out[None]["profit_change"] == -5.0


def test_missing_body_type_is_one_row(spark, business):
    contracts = spark.createDataFrame(
        [(day("2001-06-01"), None, 10.0, 1.0), (day("2001-07-01"), None, 10.0, 3.0)],
        "contract_date date, vehicle_id long, actual_price double, gross_profit double",
    )
    out = analysis.margin_drop({**business, "sl_contracts": contracts}, AS_OF, months=1).collect()
    assert [(r["body_type"], r["units_before"], r["units_after"], r["profit_change"]) for r in out] == [(None, 1, 1, 2.0)]


def test_top_model(business):
    assert rows(analysis.top_model_prev_month(business, AS_OF)) == [("a", 1)]


def test_trend(business):
    out = analysis.trend(business).filter("body_type = 'セダン'")
    assert rows(out) == [
        ("セダン", day("2001-06-01"), 1, 0.0, None, 0.0),
        ("セダン", day("2001-07-01"), 1, 300.0, None, 150.0),
    ]


def test_previous_month_is_pushed_to_the_scan(spark, small):
    text = plan(analysis.top_store_prev_month(LogicalTables(spark, small), AS_OF))
    assert "GreaterThanOrEqual(o_orderdate,2001-07-01" in text and "LessThan(o_orderdate,2001-08-01" in text


@pytest.mark.parametrize("fn", [analysis.top_store_prev_month, analysis.top_model_prev_month, analysis.heatmap, analysis.margin_drop])
def test_amounts_of_other_periods_are_dropped_before_they_are_added_up(spark, small, fn):
    t = LogicalTables(spark, small)
    out = fn(t, AS_OF)
    text = plan(out)
    assert text.index("LeftSemi") and "GreaterThanOrEqual(o_orderdate," in text
    plain = {name: t[name] for name in ("sl_contracts", "sl_stores", "sl_vehicles")}
    assert rows(out) == rows(fn(plain, AS_OF)) and not out.isEmpty()


def test_forecast_is_line_plus_season(spark):
    """Against least squares by hand: gaps count as 0, later rows are unknown, one month and a NULL group are no trouble."""
    rng, end = np.random.default_rng(4), dt.date(2001, 5, 1)
    month = lambda i: dt.date(1999 + (i // 12), i % 12 + 1, 1)
    data = [("a", month(i), float(rng.integers(1, 99))) for i in range(32) if i not in (5, 6)]
    data += [(None, month(i), 10.0 + 2 * i) for i in range(20, 28)] + [("one", month(27), 7.0)]
    got = analysis.seasonal_forecast(
        spark.createDataFrame(data, "category string, month date, sales double"), "category", "sales", end, 2, 3
    )
    want = []
    for group in ("a", None, "one"):
        own = {m: v for g, m, v in data if g == group and m < end}
        months = [month(i) for i in range(30) if month(i) >= min(own)]
        at, y = np.arange(len(months)), np.array([own.get(m, 0.0) for m in months])
        n = sum(m < end for m in months)

        def fitted(k):
            rise, level = np.polyfit(at[:k], y[:k], 1) if k > 1 else (0.0, y[:k].mean() if k else np.nan)
            line = level + rise * at
            return [
                x + (np.mean(near) if (near := [y[j] - line[j] for j in range(k) if months[j].month == months[i].month]) else 0.0)
                for i, x in enumerate(line)
            ]

        back = fitted(n - 3) if n > 3 else None
        mae = np.mean([abs(y[i] - back[i]) for i in range(n - 3, n)]) if back else None
        want += [(group, months[i], round(fitted(n)[i], 6), None if mae is None else round(float(mae), 6), n) for i in range(n, len(months))]
    out = got.select("category", "month", F.round("forecast", 6), F.round("backtest_mae", 6), "n_months")
    assert sorted(map(str, out.collect())) == sorted(map(str, spark.createDataFrame(
        [(g, m, float(f), e, n) for g, m, f, e, n in want], out.schema).collect()))

