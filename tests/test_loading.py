from __future__ import annotations

import datetime as dt
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import day, plan, rows
from forecourt.operators import quality, refresh
from forecourt.session import shuffles_released, working_folder
from forecourt.sources import files
from forecourt.streaming import ingest
from forecourt.streaming.ingest import ingest_files
from forecourt.streaming.medallion import Feed, run_medallion

RAW = "id string, ts string, value string, day date"


@pytest.fixture(scope="module")
def notes(spark):
    return spark.createDataFrame(
        [(1, "2024-01-01 10:00:00", "5"), (2, "2024-01-01 11:00:00", "bad"), (3, "2024-01-02 09:00:00", None),
         (4, "2024-01-03 09:00:00", "-1"), (5, "2024-01-03 12:00:00", "8")],
        "id int, ts string, value string",
    )


def test_many_folders_are_listed_in_few_tasks(spark):
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(setting)
    with pytest.raises(ValueError), ingest.few_listing_tasks(spark):
        assert int(spark.conf.get(setting)) <= 32 < int(before)
        raise ValueError
    assert spark.conf.get(setting) == before


def test_each_file_is_read_once(spark, notes, tmp_path):
    landing, out, checkpoint = (str(tmp_path / n) for n in ("landing", "bronze", "checkpoint"))
    files.write_daily(notes.filter("id < 4"), "ts", landing)
    for expected in (3, 3):
        ingest_files(spark, landing, RAW, out, checkpoint)
        assert spark.read.parquet(out).count() == expected
    files.write_daily(notes.filter("id >= 4"), "ts", landing)
    ingest_files(spark, landing, RAW, out, checkpoint, max_files=1)
    bronze = spark.read.parquet(out)
    assert rows(bronze.select("id", "value", "day")) == [
        ("1", "5", day("2024-01-01")), ("2", "bad", day("2024-01-01")), ("3", None, day("2024-01-02")),
        ("4", "-1", day("2024-01-03")), ("5", "8", day("2024-01-03")),
    ]
    assert bronze.filter("_ingested_at IS NULL OR NOT contains(_source_file, 'day=')").isEmpty()


def test_glob_is_one_stream(spark, notes, tmp_path):
    for n in (1, 2):
        notes.filter(F.col("id") == n).write.option("header", True).csv(str(tmp_path / f"in/part{n}"))
    out = str(tmp_path / "bronze")
    ingest_files(spark, str(tmp_path / "in/*/*.csv"), "id string, ts string, value string", out, str(tmp_path / "c"))
    assert spark.read.parquet(out).count() == 2


def test_layers_from_files_to_gold(spark, notes, tmp_path):
    feed = Feed(
        "notes", RAW, {"id": "int", "ts": "timestamp", "value": "int"}, ("id",),
        {"typed": "size(invalid) = 0", "positive": "value > 0"},
    )
    marts = {"daily": lambda s: s.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))}
    base, landing = str(tmp_path / "base"), str(tmp_path / "landing")
    files.write_daily(notes.filter("id <= 3"), "ts", landing)
    run_medallion(spark, landing, base, feed, marts)
    files.write_daily(notes, "ts", landing)  # everything once more
    for _ in range(2):
        paths = run_medallion(spark, landing, base, feed, marts)
    assert rows(spark.read.parquet(paths["daily"])) == [(day("2024-01-01"), 1, 5), (day("2024-01-03"), 1, 8)]
    counts = spark.read.parquet(paths["quality"]).groupBy("rule").agg(F.sum("passed"), F.sum("failed"))
    assert rows(counts) == [("typed", 6, 2), ("positive", 3, 5)]  # every delivered row counts
    assert paths["bronze"].endswith("/bz_notes") and paths["daily"].endswith("/gd_daily")


def test_repeats_within_the_watermark_are_dropped(spark, notes, tmp_path):
    feed = Feed("notes", RAW, {"id": "int", "ts": "timestamp"}, ("id",), event_time="ts")
    base, landing = str(tmp_path / "base"), str(tmp_path / "landing")
    for _ in range(2):
        files.write_daily(notes, "ts", landing)
    paths = run_medallion(spark, landing, base, feed, {})
    assert rows(spark.read.parquet(paths["silver"]).select("id")) == [(i,) for i in range(1, 6)]


def test_repeating_a_partition_write_changes_nothing(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, p string")
    for part in (df, df.filter("p = 'b'")):
        path = files.write_layer(part, str(tmp_path), "gold", "t", ("p",))
    assert rows(spark.read.parquet(path)) == rows(df)


def test_master_with_bad_values(spark, tmp_path):
    (tmp_path / "m.csv").write_text("id,n\n1,5\n2,x\n")
    assert rows(files.load_master(spark, str(tmp_path / "m.csv"), "id int, n int")) == [(1, 5), (2, None)]


def contracts(spark, data):
    return spark.createDataFrame(
        [(d and day(d), c, p, 1.0) for d, c, p in data],
        "contract_date date, customer_id long, actual_price double, gross_profit double",
    )


def test_refused_rows_are_taken_when_they_come_in_order(spark, tmp_path):
    feed = Feed("f", "id string, value string", {"id": "int", "value": "int"}, ("id",), {"positive": "value > 0"})
    base, landing = str(tmp_path / "base"), str(tmp_path / "landing")
    for delivery in ([("1", "-3"), ("x", "5"), ("y", "6"), ("z", "7"), (None, "8")], [("1", "3"), ("1", "4"), ("2", "1")]):
        spark.createDataFrame(delivery, "id string, value string").coalesce(1).write.mode("append").csv(landing, header=True)
        paths = run_medallion(spark, landing, base, feed, {})
    silver = rows(spark.read.parquet(paths["silver"]).select("id", "value"))
    assert silver in ([(1, 3), (2, 1)], [(1, 4), (2, 1)])
    counts = spark.read.parquet(paths["quality"]).groupBy("rule").agg(F.sum("passed"), F.sum("failed"))
    assert rows(counts) == [("positive", 7, 1)]


def test_a_failing_batch_leaves_silver_unchanged(spark, tmp_path):
    feed = Feed("f", "id string, value string", {"id": "int", "value": "int"}, ("id",), fail={"known": "value < 100"})
    base, landing = str(tmp_path / "base"), str(tmp_path / "landing")
    spark.createDataFrame([("1", "3")], "id string, value string").write.csv(landing, header=True)
    paths = run_medallion(spark, landing, base, feed, {})
    spark.createDataFrame([("2", "1"), ("3", "100")], "id string, value string").write.mode("append").csv(landing, header=True)
    with pytest.raises(Exception, match="'known' violated"):
        run_medallion(spark, landing, base, feed, {})
    assert rows(spark.read.parquet(paths["silver"]).select("id")) == [(1,)]


def test_refresh_equals_full_recompute(spark, tmp_path):
    first = contracts(spark, [("2001-01-05", 1, 10.0), ("2001-02-05", 1, 20.0), (None, 2, 5.0)])
    second = contracts(spark, [("2001-01-20", 1, 30.0), ("2001-03-01", 3, 1.0), (None, 2, 7.0)])
    base = str(tmp_path)
    refresh.refresh_incremental(spark, first, base, "one")
    untouched = set((tmp_path / "mv_monthly_sales/sales_month=2001-02-01").iterdir())
    for _ in range(2):  # the second run of a batch must not add it again
        path = refresh.refresh_incremental(spark, second, base, "two")
    got = spark.read.parquet(path).select("sales_month", "units", "sales", "customers")
    assert rows(got) == [
        (day("2001-01-01"), 2, 40.0, 1), (day("2001-02-01"), 1, 20.0, 1), (day("2001-03-01"), 1, 1.0, 1),
        (None, 2, 12.0, 1),
    ]
    assert set((tmp_path / "mv_monthly_sales/sales_month=2001-02-01").iterdir()) == untouched


def test_a_batch_loaded_again_with_other_months(spark, tmp_path):
    base = str(tmp_path)
    refresh.refresh_incremental(spark, contracts(spark, [("2001-01-05", 1, 10.0), ("2001-02-05", 1, 20.0), (None, 9, 1.0)]), base, "one")
    refresh.refresh_incremental(spark, contracts(spark, [("2001-01-07", 2, 1.0)]), base, "two")
    path = refresh.refresh_incremental(spark, contracts(spark, [("2001-01-06", 1, 11.0), ("2001-03-05", 1, 30.0)]), base, "one")
    got = spark.read.parquet(path).select("sales_month", "units", "sales")
    assert rows(got) == [(day("2001-01-01"), 2, 12.0), (day("2001-03-01"), 1, 30.0)]
    assert refresh.stored_months(spark, base, "one") == {day("2001-01-01"), day("2001-03-01")}


def test_many_months_use_a_semi_join(spark, monkeypatch):
    data = contracts(spark, [("2001-01-05", 1, 10.0), ("2001-02-05", 1, 20.0), (None, 2, 5.0)])
    stored = data.withColumn("sales_month", F.trunc("contract_date", "MM"))
    months = {None, day("2001-01-01")}
    few = rows(refresh.rows_of_months(stored, months))
    monkeypatch.setattr(refresh, "LISTED_MONTHS", 0)
    assert rows(refresh.rows_of_months(stored, months)) == few and len(few) == 2


def test_working_folder_prefers_the_shared_one(spark):
    assert working_folder(spark, "x") != working_folder(spark, "x")

    def session(master, shared=None):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default=None: shared or default),
            sparkContext=SimpleNamespace(master=master),
        )

    assert working_folder(session("yarn", "s3://shared/"), "x").startswith("s3://shared/forecourt/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        working_folder(session("yarn"), "x")


def test_lines_with_other_numbers_of_fields_are_kept_aside(spark, tmp_path):
    from forecourt.streaming.ingest import ingest_checked

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text('a,b\n1,x\n2\n3,y,z\n,\n"4","q,r"\n')
    args = [str(tmp_path / p) for p in ("in", "out", "aside", "mark")]
    for _ in range(2):
        ingest_checked(spark, args[0], "a string, b string", *args[1:])
    kept = [tuple(r) for r in spark.read.parquet(args[1]).select("a", "b").collect()]
    assert sorted(kept, key=str) == [("1", "x"), ("4", "q,r"), (None, None)]
    aside = spark.read.parquet(args[2]).collect()
    assert sorted(r._line for r in aside) == ["2", "3,y,z"]
    assert all(r._source_file.endswith("a.csv") and r._ingested_at for r in aside)


def test_a_refresh_reads_the_touched_months_only(spark, tmp_path):
    base = str(tmp_path)
    columns = "contract_date date, actual_price double, gross_profit double, customer_id long"
    for batch, month in (("1", 1), ("2", 2), ("3", 1)):
        delta = spark.createDataFrame([(dt.date(2001, month, 3), 10.0, 1.0, month)], columns)
        refresh.refresh_incremental(spark, delta, base, batch)
    path = refresh.layer_path(base, "silver", "contracts")
    own = refresh.stored_rows(spark, path, refresh.month_folder(dt.date(2001, 1, 1)))
    assert {f.split("sales_month=")[1][:10] for f in own.inputFiles()} == {"2001-01-01"}
    got = {r.sales_month: r.units for r in spark.read.parquet(refresh.summary_path(base)).collect()}
    assert got == {dt.date(2001, 1, 1): 2, dt.date(2001, 2, 1): 1}
    with pytest.raises(ValueError):
        refresh.refresh_incremental(spark, delta, base, "a/b")


@pytest.mark.parametrize("broadcast", [True, False])
def test_repeats_are_found_among_stored_rows(spark, tmp_path, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(quality, "fits_broadcast", lambda frame: False)
    bronze, out, mark = (str(tmp_path / n) for n in ("bronze", "silver", "mark"))
    types = {"id": "int", "part": "int"}
    for delivery in ([("1", "1"), ("1", "1"), ("1", "2"), (None, "1")], [("1", "2"), ("2", "1")], [("1", "1"), ("3", "1"), ("3", "1")]):
        landed = spark.createDataFrame(delivery, "id string, part string").withColumn("value", F.lit("v")).coalesce(1)
        landed.write.mode("append").parquet(bronze)
        ingest.refine(spark, bronze, out, str(tmp_path / "metrics"), mark, types, {}, ("id", "part"), max_files=1)
    silver = spark.read.parquet(out)
    assert rows(silver.select("id", "part", "value", "batch_id")) == [(1, 1, "v", 0), (1, 2, "v", 0), (2, 1, "v", 1), (3, 1, "v", 2)]
    assert silver.columns == ["id", "part", "value", "invalid", "batch_id"]
    assert not (tmp_path / "mark/rows/state").exists()  # no key is held from batch to batch


def test_a_batch_run_again_takes_its_rows_again(spark, tmp_path):
    bronze, out, mark = (str(tmp_path / n) for n in ("bronze", "silver", "mark"))
    args = (spark, bronze, out, str(tmp_path / "metrics"), mark, {"id": "int"}, {}, ("id",))
    for ids in (["1", "2"], ["2", "3"]):
        spark.createDataFrame([(i,) for i in ids], "id string").coalesce(1).write.mode("append").parquet(bronze)
        ingest.refine(*args)
    for commit in (tmp_path / "mark/rows/commits").glob("*1*"):  # the second batch was written but not marked as done
        commit.unlink()
    ingest.refine(*args)
    assert rows(spark.read.parquet(out).select("id", "batch_id")) == [(1, 0), (2, 0), (3, 1)]


def test_only_keys_are_shuffled_to_find_repeats(spark):
    wide = spark.range(100).select("id", F.repeat(F.lit("x"), 100).alias("text"))
    text = plan(quality.repeated_keys(wide, ["id"], wide))
    assert "text" not in text and "Exchange" in text
    none = quality.repeated_keys(wide, ["id"])
    assert none.isEmpty() and "Exchange" not in plan(quality.without_repeats(wide, ["id"], none))


def test_shuffle_files_go_when_a_query_has_ended(spark, tmp_path):
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffled():
        return {f for f in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f and f.endswith(".data")}

    with pytest.raises(ValueError), shuffles_released(spark):
        before = shuffled()
        spark.range(1000).repartition(4, "id").write.parquet(str(tmp_path / "t"))
        until = time.time() + 20
        while shuffled() - before and time.time() < until:
            time.sleep(0.2)
        assert not shuffled() - before
        raise ValueError
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_what_a_delivery_leaves_on_disk(spark, business, tmp_path, monkeypatch):
    from forecourt.queries import loading

    monkeypatch.setattr(loading, "working_folder", lambda spark, purpose: str(tmp_path))
    late = business["sl_contracts"]
    early = late.withColumns({"contract_id": F.col("contract_id") + 100, "contract_date": F.add_months("contract_date", -24)})
    out = loading.pipeline_gold(spark, {**business, "sl_contracts": early.unionByName(late)})
    sold = {(r.prefecture, str(r.sales_month), r.maker, r.units, r.sales) for r in out.collect()}
    assert {m for _, m, *_ in sold} == {"1999-06-01", "1999-07-01", "2001-06-01", "2001-07-01"}
    assert ("Tokyo", "2001-07-01", "M2", 1, 300.0) in sold and (None, "1999-06-01", None, 1, 50.0) in sold and len(sold) == 8
    assert not list(tmp_path.glob("delivered/**/*.parquet"))  # the landing folder has these rows
    landed = list(tmp_path.glob("landing/day=*/part-*"))
    assert landed and all(p.name.endswith(".csv.gz") for p in landed)
    for table in ("bz_contract_feed", "sl_contract_feed", "sl_contracts"):
        stored = list(tmp_path.glob(f"{table}/**/part-*.parquet"))
        assert stored and all(".zstd." in p.name for p in stored), table


def test_deliveries_are_worked_out_once(spark, small, tmp_path):
    from conftest import plan
    from forecourt.queries.loading import _deliveries
    from forecourt.sources.bindings import LogicalTables

    tables = LogicalTables(spark, small)
    right, late = _deliveries(spark, tables, str(tmp_path))
    for delivery in (right, late):  # stored rows: no sums over line items, no joins with their orders
        assert "Aggregate" not in plan(delivery) and "Join" not in plan(delivery)
    assert rows(right.unionByName(late)) == rows(tables["sl_contracts"])
    assert late.count() > 0 and right.count() > 0
