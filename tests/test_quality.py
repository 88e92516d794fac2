from __future__ import annotations

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import final_plan, plan, rows
from forecourt.operators import quality


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [(1, "5", 2000), (1, "x", 2001), (2, None, 1980), (None, "7", None)], "id int, text string, year int"
    )


RULES = {"recent": "year >= 1990", "texted": "text IS NOT NULL"}


def test_null_is_a_violation_when_dropping(items):
    assert rows(quality.expect_or_drop(items, RULES)) == [(1, "5", 2000), (1, "x", 2001)]
    assert quality.expect_or_drop(items, {}).count() == 4


def test_fail_names_the_rule(items):
    with pytest.raises(Exception, match="'recent' violated"):
        quality.expect_or_fail(items, RULES).collect()
    good = items.filter("year >= 1990")
    assert rows(quality.expect_or_fail(good, RULES)) == rows(good)


def test_metrics(items):
    assert rows(quality.quality_metrics(items, RULES)) == [("recent", 2, 2), ("texted", 3, 1)]
    assert rows(quality.quality_metrics(items.limit(0), RULES)) == [("recent", 0, 0), ("texted", 0, 0)]


def test_metrics_are_one_pass(spark, small):
    part = spark.read.parquet(f"{small}/part.parquet")
    text = plan(quality.quality_metrics(part, {"a": "p_size > 3", "b": "p_retailprice > 1"}))
    assert text.count("ReadSchema") == 1
    assert "ReadSchema: struct<p_size:int,p_retailprice:double>" in text


def test_observed_counts_come_with_the_job(items):
    seen = Observation()
    quality.observed(items, RULES, seen).collect()
    assert seen.get == {"n": 4, "failed_recent": 2, "failed_texted": 1}


def test_typed_lists_what_did_not_fit(items):
    out = quality.typed(items, {"text": "int"})
    assert dict(out.dtypes)["text"] == "int"
    assert rows(out.select("text", "invalid")) == [(5, []), (7, []), (None, ["text"]), (None, [])]


def test_typed_casts_in_generated_code(items):
    out = quality.typed(items, {"text": "int", "year": "bigint"}).filter("size(invalid) = 0")
    steps = [line for line in plan(out).splitlines() if line.lstrip("+- ").split(" ")[0] in ("*", "Project", "Filter")]
    assert any("Project" in s for s in steps) and any("Filter" in s for s in steps)
    assert all(s.lstrip("+- ").startswith("*") for s in steps if "Project" in s or "Filter" in s), steps


def test_dedup_keeps_the_first(items):
    out = quality.dedup(items, ["id"], [F.desc("year")])
    assert rows(out) == [(1, "x", 2001), (2, None, 1980), (None, "7", None)]


def test_dedup_limits_groups_before_the_shuffle(spark, small):
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    text = plan(quality.dedup(lines, ["l_orderkey"], ["l_linenumber"]))
    exchange = text.index("Exchange")
    assert text.count("WindowGroupLimit") >= 2
    assert "Mode: Partial" in text or "Partial" in text[exchange:]


def test_primary_key(items):
    assert rows(quality.check_pk(items, ["id"])) == [(1, 2), (None, 1)]
    assert rows(quality.check_pk(items, ["id", "text"])) == [(2, None, 1), (None, "7", 1)]


def test_foreign_key_counts_values_before_the_join(spark, items):
    parents = spark.createDataFrame([(2,)], "k int")
    found = quality.check_fk(items, "id", parents, "k")
    assert rows(found) == [(1, 2)]
    text = final_plan(found)
    assert text.index("LeftAnti") and text.count("HashAggregate") >= 2
