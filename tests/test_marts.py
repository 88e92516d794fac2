from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import day, plan, rows
from forecourt.functions import masking
from forecourt.operators import gold, silver


def test_store_monthly_sales(business):
    assert rows(gold.store_monthly_sales(business["sl_contracts"])) == [
        (1, day("2001-07-01"), 2, 400.0, 50.0),
        (2, day("2001-06-01"), 1, 0.0, -5.0),
        (None, day("2001-06-01"), 1, 50.0, 5.0),
    ]


def test_dashboard_total_is_not_a_sum_of_distinct_counts(business):
    both = business["sl_contracts"].withColumn("customer_id", F.lit(100))
    out = gold.dashboard_kpi(both).select("sales_month", "is_total", "units", "customers")
    assert rows(out) == [
        (day("2001-06-01"), False, 2, 1),
        (day("2001-07-01"), False, 2, 1),
        (None, True, 4, 1),
    ]


def test_sales_by_attribute_keeps_contracts_without_vehicle(business):
    out = gold.sales_by_vehicle_attribute(business["sl_contracts"], business["sl_vehicles"], "maker")
    assert rows(out) == [("M1", 1, 100.0, 20.0), ("M2", 2, 300.0, 25.0), (None, 1, 50.0, 5.0)]


def test_market_linked_margin(business):
    out = gold.market_linked_margin(
        business["sl_contracts"], business["sl_vehicles"], business["sl_market_index"]
    )
    assert rows(out.select("month", "category", "margin_rate", "market_index")) == [
        (day("2001-06-01"), "セダン", None, 5.0),
        (day("2001-07-01"), "SUV", 0.2, 12.0),
        (day("2001-07-01"), "セダン", 0.1, 6.0),
    ]


def test_margin_score(spark, business):
    contracts = spark.createDataFrame(
        [(i, day("2001-07-05"), 1, v, 100.0, p) for i, v, p in
         [(1, 10, 10.0), (2, 10, 30.0), (3, 11, 5.0), (4, 99, 5.0), (5, 99, 15.0)]],
        "contract_id long, contract_date date, store_id long, vehicle_id long, actual_price double, gross_profit double",
    )
    out = gold.margin_score(contracts, business["sl_vehicles"])
    scores = {r["contract_id"]: r["score"] for r in out.collect()}
    assert scores[3] is None  # alone in its group
    assert [round(scores[i], 9) for i in (1, 2, 4, 5)] == [-1.0, 1.0, -1.0, 1.0]  # NULL category is a group
    assert "Window" not in plan(out)


def test_small_sides_are_joined_after_gathering_by_month(business, monkeypatch):
    monkeypatch.setattr(silver, "broadcast_if_small", lambda frames: {k: F.broadcast(f) for k, f in frames.items()})
    sides = business["sl_stores"], business["sl_vehicles"], silver.BODY_TYPE_SPELLINGS
    text = plan(silver.to_silver(business["sl_contracts"], *sides, by_month=True))
    arguments = [line for line in text.splitlines() if "REBALANCE_PARTITIONS_BY_COL" in line]
    assert len(arguments) == 1 and text.count("BroadcastHashJoin") >= 2
    shuffled = text[: text.index(arguments[0])].rsplit("Input [", 1)[1].splitlines()[0]
    assert "sales_month" in shuffled and not any(c in shuffled for c in ("store_name", "maker", "margin_rate"))
    assert rows(silver.to_silver(business["sl_contracts"], *sides, by_month=True)) == rows(
        silver.to_silver(business["sl_contracts"], *sides)
    )


@pytest.mark.parametrize("large", ["sl_stores", "sl_vehicles"])
def test_large_sides_are_joined_first(business, monkeypatch, large):
    sides = business["sl_stores"], business["sl_vehicles"], silver.BODY_TYPE_SPELLINGS
    want = rows(silver.to_silver(business["sl_contracts"], *sides))
    key = "store_id" if large == "sl_stores" else "vehicle_id"
    monkeypatch.setattr(
        silver, "broadcast_if_small", lambda frames: {k: f if k == key else F.broadcast(f) for k, f in frames.items()}
    )
    for by_month in (False, True):
        assert rows(silver.to_silver(business["sl_contracts"], *sides, by_month=by_month)) == want


def test_rm_segment(business):
    out = gold.rm_segment(
        business["sl_customers"], business["sl_inquiries"], business["sl_contracts"], day("2001-08-01")
    ).select("customer_id", "months_since", "n_contracts", "total_value", "rm_segment")
    assert rows(out) == [
        (100, 0, 2, 400.0, "R1-M1"),
        (101, 1, 2, 50.0, "R1-M1"),
        (102, None, 0, 0.0, "R0-M1"),
    ]


def test_map_category():
    spellings = {**silver.BODY_TYPE_SPELLINGS, **{c: c for c in silver.BODY_TYPES}}
    assert len(silver.BODY_TYPES) == 6 and set(spellings.values()) == set(silver.BODY_TYPES)


@pytest.mark.parametrize(
    ("text", "category"),
    [("軽", "軽自動車"), (" suv ", "SUV"), ("輸入車", "輸入車"), ("バス", None), (None, None)],
)
def test_category_spellings(spark, text, category):
    spellings = {**silver.BODY_TYPE_SPELLINGS, **{c: c for c in silver.BODY_TYPES}}
    df = spark.createDataFrame([(text,)], "c string")
    assert df.select(silver.map_category("c", spellings)).first()[0] == category


def test_to_silver_keeps_every_contract(business):
    spellings = {c: c for c in silver.BODY_TYPES}
    out = silver.to_silver(business["sl_contracts"], business["sl_stores"], business["sl_vehicles"], spellings)
    assert rows(out.select("contract_id", "store_name", "category", "margin_rate")) == [
        (1, "North", "SUV", 0.2),
        (2, "North", "セダン", 0.1),
        (3, "South", "セダン", None),
        (4, None, None, 0.1),
    ]


def test_enrichment_only_fills_gaps(spark, business):
    profile = spark.createDataFrame(
        [(101, 99.0, "family"), (102, 30.0, None)], "customer_id long, budget double, stage string"
    )
    out = silver.enrich_customers(business["sl_customers"], profile, "customer_id")
    assert rows(out.select("customer_id", "budget", "stage")) == [
        (100, 10.0, None),
        (101, 20.0, "family"),
        (102, 30.0, None),
    ]


def test_masks(business):
    customers, vehicles = business["sl_customers"], business["sl_vehicles"]
    masked = masking.apply_masks(customers, masking.CUSTOMER_MASKS).select("name", "phone")
    assert [tuple(r) for r in masked.collect()] == [("****", "***-****-5678"), ("**", "**"), (None, None)]
    hidden = masking.apply_masks(vehicles, masking.VEHICLE_MASKS).select("vin", "plate_number")
    assert [tuple(r) for r in hidden.collect()] == [("*" * 17, "****"), ("*" * 17, "****"), (None, None)]


def test_privileged_readers_see_everything(business):
    customers = business["sl_customers"]
    assert rows(masking.apply_masks(customers, masking.CUSTOMER_MASKS, privileged=True)) == rows(customers)


@pytest.mark.parametrize(
    ("phone", "shown"), [("0312345678", "******5678"), ("1234", "****"), ("", ""), ("tel 0123 ", "tel *123 ")]
)
def test_phone_edges(spark, phone, shown):
    df = spark.createDataFrame([(phone,)], "phone string")
    assert df.select(masking.mask_phone("phone")).first()[0] == shown
