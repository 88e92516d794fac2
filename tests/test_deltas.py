from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from forecourt.operators import deltas
from forecourt.operators.gold import ratio

SCHEMA = "contract_date date, store_id long, customer_id long, actual_price double, gross_profit double"
MART = deltas.SignedMart(
    "m", ("store_id",), sums={"sales": "actual_price", "gross_profit": "gross_profit"}, distinct={"customers": "customer_id"},
    finish=lambda mart: mart.withColumn("margin_rate", ratio("gross_profit", "sales")),
)


def delivery(rng, n):
    return [
        (
            rng.choice([None, dt.date(2001, rng.randint(1, 3), rng.randint(1, 28))]), rng.choice([1, 2, None]),
            rng.choice([None, 7, 8, 9]), rng.choice([None, 0.1, 0.2, 1e9 + 0.3]), rng.choice([0.1, -0.2]),
        )
        for _ in range(n)
    ]


def expected(spark, batches):
    df = spark.createDataFrame([r for b in batches.values() for r in b], SCHEMA)
    full = df.groupBy("store_id", F.trunc("contract_date", "MM").alias("sales_month")).agg(
        F.count(F.lit(1)).alias("units"), F.sum(F.col("actual_price").cast("decimal(28,4)")).cast("double").alias("sales"),
        F.sum(F.col("gross_profit").cast("decimal(28,4)")).cast("double").alias("gross_profit"),
        F.count_distinct("customer_id").alias("customers"),
    )
    return full.withColumn("margin_rate", ratio("gross_profit", "sales"))


def stored(spark, path, like):
    return spark.read.parquet(path).withColumn("sales_month", F.col("sales_month").cast("date")).select(*like.columns)


def test_any_order_of_deliveries_equals_a_full_recompute(spark, tmp_path):
    rng, batches = random.Random(3), {}
    for batch, n in (("a", 30), ("b", 5), ("a", 3), ("c", 20), ("b", 0), ("a", 25), ("c", 1)):
        batches[batch] = delivery(rng, n)
        path = deltas.apply_load(spark, spark.createDataFrame(batches[batch], SCHEMA), str(tmp_path), batch, MART)
        full = expected(spark, batches)
        assert rows(stored(spark, path, full)) == rows(full)


def test_a_month_without_rows_goes(spark, tmp_path):
    base = str(tmp_path)
    for month in (1, 2):
        only = spark.createDataFrame([(dt.date(2001, month, 5), 1, 7, 1.0, 1.0)], SCHEMA)
        path = deltas.apply_load(spark, only, base, "a", MART)
    assert rows(spark.read.parquet(path).select("sales_month", "units")) == [(dt.date(2001, 2, 1), 1)]


@pytest.mark.parametrize("broken", ["state", "mart", "batch"])
def test_a_run_broken_off_is_finished_once(spark, tmp_path, monkeypatch, broken):
    """The next run, of another batch, completes what was logged, wherever it ended."""
    rng, base = random.Random(5), str(tmp_path)
    batches = {b: delivery(rng, 12) for b in "abc"}
    for b in "ab":
        deltas.apply_load(spark, spark.createDataFrame(batches[b], SCHEMA), base, b, MART)
    batches["a"] = delivery(rng, 6)
    with monkeypatch.context() as m:
        if broken == "batch":
            mark, calls = deltas._mark, []
            m.setattr(deltas, "_mark", lambda *a: 1 / 0 if calls else (calls.append(1), mark(*a)))
        else:
            name, write = ("m_state" if broken == "state" else "m"), deltas.write_layer
            m.setattr(deltas, "write_layer", lambda df, base, layer, n, parts: 1 / 0 if n == name else write(df, base, layer, n, parts))
        with pytest.raises(ZeroDivisionError):
            deltas.apply_load(spark, spark.createDataFrame(batches["a"], SCHEMA), base, "a", MART)
    path = deltas.apply_load(spark, spark.createDataFrame(batches["c"], SCHEMA), base, "c", MART)
    full = expected(spark, batches)
    assert rows(stored(spark, path, full)) == rows(full)


def test_only_the_batch_and_its_months_are_read(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    for batch, month in (("a", 1), ("b", 1), ("c", 2)):
        deltas.apply_load(spark, spark.createDataFrame([(dt.date(2001, month, 5), 1, 7, 1.0, 1.0)], SCHEMA), base, batch, MART)
    read, added = [], deltas._added
    monkeypatch.setattr(deltas, "_added", lambda df, mart: (read.extend(df.inputFiles()), added(df, mart))[1])
    deltas.apply_load(spark, spark.createDataFrame([(dt.date(2001, 1, 9), 1, 8, 2.0, 1.0)], SCHEMA), base, "a", MART)
    folders = {f.split("/m_")[-1].split("/part-")[0] for f in (f.replace("mv_m_", "/m_") for f in read)}
    assert {f.split("/")[0] for f in folders} == {"log", "batches", "state"}
    assert {f for f in folders if not f.startswith("log")} == {"batches/a", "state/sales_month=2001-01-01"}
