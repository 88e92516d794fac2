"""Plans hold up on large and skewed data."""

from __future__ import annotations

import datetime as dt
from contextlib import contextmanager
from functools import partial

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import final_plan, plan, rows
from forecourt.operators import analysis, gold, joins
from forecourt.operators.ranking import ranked
from forecourt.plans.views import KPI_SALES
from forecourt.queries import QUERIES


@contextmanager
def settings(spark, **conf):
    names = {key.replace("__", "."): value for key, value in conf.items()}
    before = {key: spark.conf.get(key, None) for key in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# Thresholds scaled down so that a few thousand rows count as a large table.
SCALED_DOWN = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20kb",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10kb",
    "spark__sql__adaptive__coalescePartitions__minPartitionSize": "1kb",
}


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the contracts on one vehicle, store and day, a third without vehicle."""
    n = F.col("id")
    hot = n % 3 == 0
    vehicle = F.when(hot, 7).when(n % 3 == 1, n % 500)
    contracts = spark.range(0, 60_000, 1, 8).select(
        n.alias("contract_id"),
        F.date_add(F.lit("2001-01-01").cast("date"), F.when(hot, 0).otherwise(n % 200).cast("int")).alias(
            "contract_date"
        ),
        (n % 1000).alias("customer_id"),
        F.when(hot, 1).otherwise(n % 10).alias("store_id"),
        vehicle.alias("vehicle_id"),
        (n % 97).cast("double").alias("actual_price"),
        (n % 13).cast("double").alias("gross_profit"),
    )
    vehicles = spark.range(0, 500).select(
        n.alias("vehicle_id"),
        F.concat(F.lit("m"), n % 5).alias("maker"),
        F.concat(F.lit("b"), n % 6).alias("body_type"),
        F.lit(True).alias("certified"),
    )
    return {"sl_contracts": contracts, "sl_vehicles": vehicles}


def test_hot_and_missing_keys_of_a_metric_view_are_split(spark, skewed):
    ask = dict(dims=["メーカー"], measures=["契約件数", "売上合計", "ユニーク顧客数"], tables=skewed)
    want = rows(KPI_SALES.query(spark, **ask))
    with settings(spark, **SCALED_DOWN):
        out = KPI_SALES.query(spark, broadcast_bytes=0, **ask)
        text = final_plan(out)
        assert rows(out) == want
    assert "skew=true" in text or "skewed" in text


def test_margin_score_splits_a_hot_group(spark, skewed):
    want = rows(gold.margin_score(skewed["sl_contracts"], skewed["sl_vehicles"]).groupBy("category").count())
    with settings(spark, **SCALED_DOWN):
        out = gold.margin_score(skewed["sl_contracts"], skewed["sl_vehicles"])
        text = final_plan(out)
        assert rows(out.groupBy("category").count()) == want
    assert "skew=true" in text or "skewed" in text


def test_vehicle_sums_are_the_same_on_both_ways(spark, skewed):
    args = skewed["sl_contracts"], skewed["sl_vehicles"], "body_type", "store_id"
    near, far = gold.sales_by_vehicle_attribute(*args), None
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        far = gold.sales_by_vehicle_attribute(*args, broadcast_bytes=0)
        # Contracts are summed before they are shuffled to the join.
        text = plan(far)
        assert text.index("SortMergeJoin") and text.count("HashAggregate (") >= 4
        assert rows(near) == rows(far)
    assert plan(near).count("Exchange (") <= plan(far).count("Exchange (")


@pytest.mark.parametrize("pieces", [2, 7, 500])
def test_ranks_in_pieces_are_exact(spark, pieces):
    n = F.col("id")
    df = spark.range(4000).select(
        n,
        F.when(n % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), n % 5)).alias("g"),
        F.when(n % 4 == 0, 0.0).otherwise((n * 37 % 500).cast("double")).alias("v"),  # many ties
    )
    best_first = Window.partitionBy("g").orderBy(F.desc("v"))
    want = df.select("id", F.rank().over(best_first), F.dense_rank().over(best_first))
    got = ranked(df, "g", "v", pieces).select("id", "rank", "dense_rank")
    assert rows(got) == rows(want)
    assert ranked(df.limit(0), "g", "v", pieces).isEmpty()


def test_analyses_are_the_same_on_both_ways(business):
    turnover_days = partial(analysis.turnover_days, as_of=dt.date(2001, 8, 1))
    for fn in (analysis.store_ranking, analysis.top3_segment, turnover_days):
        assert rows(fn(business)) == rows(fn(business, broadcast_bytes=0))
    assert rows(analysis.store_ranking(business)) == rows(analysis.store_ranking(business, window_rows=0))


def test_nested_columns_are_measured(spark):
    df = spark.range(1000).select(F.transform(F.sequence(F.lit(1), F.lit(1000)), lambda i: i.cast("double")).alias("v"))
    assert joins.measured_bytes({"a": df})["a"] >= 8_000_000
    text = spark.range(10).select(F.struct(F.repeat(F.lit("x"), 1000).alias("s")).alias("v"))
    assert joins.measured_bytes({"a": text})["a"] >= 10_000


def test_a_grown_table_is_measured_again(spark, tmp_path):
    path = str(tmp_path / "t")
    sizes = []
    for n in (10, 10_000):
        spark.range(n).write.mode("append").parquet(path)
        sizes.append(joins.measured_bytes({"a": spark.read.parquet(path)})["a"])
    assert sizes[1] > 500 * sizes[0]


def test_large_files_are_not_measured(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(10_000).write.parquet(path)
    monkeypatch.setattr(joins, "measured_bytes", lambda frames: dict.fromkeys(frames, 0) if not frames else 1 / 0)
    side = spark.read.parquet(path)
    assert joins.broadcast_if_small({"a": side}, 100)["a"] is side and not joins.fits_broadcast(side, 100)


def test_top_k_needs_no_full_sort(spark, small):
    assert "TakeOrderedAndProject" in plan(QUERIES["kpi_top_areas"](spark, small))
    assert "TakeOrderedAndProject" in plan(QUERIES["nearest_items"](spark, small))


WRITING = {
    "ingest_incremental", "ingest_audit", "ingest_master", "landing_daily_counts", "medallion_gold", "dq_stream_metrics",
    "mv_incremental", "mv_incremental_store", "mv_signed", "mv_signed_store", "chunk_topk", "pipeline_gold",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_pairing_joins_and_no_row_at_a_time_python(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert node not in text


@pytest.mark.parametrize("name", ["dq_derived_primary_keys", "dq_derived_fk_orphans"])
def test_derived_tables_add_contracts_up_once(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "l_extendedprice" not in text and "/contracts" in text


def test_a_derived_table_is_made_once_for_all_its_references(spark, small):
    text = plan(QUERIES["dq_derived_fk_orphans"](spark, small))
    assert "/gd_contract_margin_score" in text and "/sl_inquiries_enriched" in text
