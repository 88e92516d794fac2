"""Ingestion, layer and refresh queries. They land the given tables as files first."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from forecourt.operators import deltas, refresh, silver
from forecourt.operators.gold import ratio
from forecourt.queries.registry import query, rounded
from forecourt.session import shuffles_released, working_folder
from forecourt.sources import files
from forecourt.sources.bindings import with_tables
from forecourt.streaming.ingest import ingest_checked, ingest_files
from forecourt.streaming.medallion import Feed, run_medallion

_RAW_EVENTS = "event_id string, ts string, user_id string, event_type string, value string, props string, day date"
_SECOND_DELIVERY = dt.date(2024, 1, 16)


def _ingest_twice(spark, t, purpose):
    """Events land by day in two deliveries, with an ingestion run after each and one more."""
    base = working_folder(spark, purpose)
    landing, out, checkpoint = f"{base}/landing", f"{base}/bz_events", f"{base}/_checkpoint"
    early = F.to_date("ts") < F.lit(_SECOND_DELIVERY)
    for delivery in (t["events"].filter(early), t["events"].filter(~early)):
        files.write_daily(delivery, "ts", landing)
        ingest_files(spark, landing, _RAW_EVENTS, out, checkpoint)
    ingest_files(spark, landing, _RAW_EVENTS, out, checkpoint)
    return spark.read.parquet(out)


@query(
    "ingest_incremental",
    """
SELECT event_id, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INT) AS k,
  CAST(ts AS DATE) AS day FROM events""",
)
def ingest_incremental(spark, t):
    """Each landed file is read once, over three runs."""
    return _ingest_twice(spark, t, "ingest").select(
        F.col("event_id").cast("long").alias("event_id"),
        F.col("user_id").cast("long").alias("user_id"),
        "event_type",
        F.col("value").cast("double").alias("value"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        "day",
    )


@query(
    "ingest_audit",
    """
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS file_day, count(*) AS n, true AS stamped
FROM events GROUP BY 1, 3""",
)
def ingest_audit(spark, t):
    """Every bronze row names its file and the time it was read."""
    bronze = _ingest_twice(spark, t, "audit")
    return bronze.groupBy(
        F.regexp_extract("_source_file", r"day=(\d{4}-\d{2}-\d{2})/", 1).alias("file_day")
    ).agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("_ingested_at").isNotNull()).alias("stamped")
    )


@query("ingest_master", with_tables("sl_vehicles") + "\nSELECT * FROM sl_vehicles")
def ingest_master(spark, t):
    """A master written as CSV and read back with its schema."""
    path = f"{working_folder(spark, 'master')}/vehicles"
    t["sl_vehicles"].write.option("header", True).csv(path)
    return files.load_master(spark, path, t["sl_vehicles"].schema)


@query(
    "landing_daily_counts",
    """
SELECT CAST(ts AS DATE) AS day, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY 1""",
)
def landing_daily_counts(spark, t):
    """Rows per landed day."""
    path = f"{working_folder(spark, 'landing')}/events"
    files.write_daily(t["events"], "ts", path)
    landed = spark.read.schema(_RAW_EVENTS).option("header", True).csv(path)
    return landed.groupBy("day").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("value").cast("double")), 4).alias("value")
    )


@query(
    "ingest_quarantine",
    """
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS file_day, count(*) AS delivered,
  count(*) FILTER (event_id % 40 >= 2) AS accepted,
  count(*) FILTER (event_id % 40 = 0) AS short, count(*) FILTER (event_id % 40 = 1) AS long,
  round(coalesce(sum(value) FILTER (event_id % 40 >= 2), 0), 4) AS value
FROM events GROUP BY 1""",
)
def ingest_quarantine(spark, t):
    """Delivered lines by day: those accepted, and those kept aside because a field is missing or too many.

    Every fortieth line lacks its last field, and every fortieth has one more.
    """
    base = working_folder(spark, "quarantine")
    columns = ["event_id", "user_id", "event_type", "value"]
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    kind = F.col("event_id") % 40
    line = F.when(kind == 0, F.concat_ws(",", *fields[:-1])).when(kind == 1, F.concat_ws(",", *fields, F.lit("more")))
    lines = t["events"].select(
        F.to_date("ts").alias("day"), line.otherwise(F.concat_ws(",", *fields)).alias("event_id,user_id,event_type,value")
    )
    landing, out, aside = f"{base}/landing", f"{base}/bz_events", f"{base}/bz_events_quarantine"
    # One column without quotes: its name is the header line, its values are the lines as they are.
    writer = lines.hint("rebalance", "day").write.partitionBy("day").option("header", True)
    writer.option("quote", "").option("sep", "\t").csv(landing)
    schema = ", ".join(f"{c} string" for c in columns) + ", day date"
    for _ in range(2):  # the second run finds nothing new
        ingest_checked(spark, landing, schema, out, aside, f"{base}/_checkpoint")
    day = F.regexp_extract("_source_file", r"day=(\d{4}-\d{2}-\d{2})/", 1).alias("file_day")
    kept = spark.read.parquet(out).select(day, F.lit(0).alias("fields"), F.col("value").cast("double").alias("value"))
    refused = spark.read.parquet(aside).select(
        day, F.size(F.split("_line", ",")).alias("fields"), F.lit(None).cast("double").alias("value")
    )
    return kept.unionByName(refused).groupBy("file_day").agg(
        F.count(F.lit(1)).alias("delivered"),
        F.count_if(F.col("fields") == 0).alias("accepted"),
        F.count_if(F.col("fields") == 3).alias("short"),
        F.count_if(F.col("fields") == 5).alias("long"),
        F.round(F.coalesce(F.sum("value"), F.lit(0.0)), 4).alias("value"),
    )


EVENT_FEED = Feed(
    name="events",
    raw_schema=_RAW_EVENTS,
    types={"event_id": "bigint", "ts": "timestamp", "user_id": "bigint", "value": "double"},
    keys=("event_id",),
    rules={
        "typed": "size(invalid) = 0",
        "value_present": "value IS NOT NULL",
        "no_error_events": "event_type <> 'error'",
    },
)


def _daily_mart(events):
    return events.groupBy("day", "event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("value").alias("value"),
        F.count_distinct("user_id").alias("users"),
    )


_RAW_CONTRACTS = (
    "contract_id string, inquiry_id string, contract_date string, customer_id string, store_id string,"
    " vehicle_id string, actual_price string, gross_profit string, day date"
)
CONTRACT_FEED = Feed(
    name="contract_feed",
    raw_schema=_RAW_CONTRACTS,
    types={
        "contract_id": "bigint",
        "inquiry_id": "bigint",
        "contract_date": "date",
        "customer_id": "bigint",
        "store_id": "bigint",
        "vehicle_id": "bigint",
        "actual_price": "double",
        "gross_profit": "double",
    },
    keys=("contract_id",),
    rules={"typed": "size(invalid) = 0"},
    fail={"priced": "actual_price IS NULL OR actual_price > -1e12"},
)


_LATE = "contract_date >= DATE'2001-06-01' OR (store_id = 7 AND trunc(contract_date, 'MM') = DATE'2000-03-01')"


# The folders of the earlier and the late contracts.
_DELIVERED = ({"late": "false"}, {"late": "true"})


def _deliveries(spark, t, base):
    """The earlier and the late contracts, worked out once and stored apart, so that a delivery reads its own rows only."""
    path = f"{base}/delivered"
    marked = t["sl_contracts"].withColumn("late", F.coalesce(F.expr(_LATE), F.lit(False)))
    marked.write.partitionBy("late").option("compression", files.COMPRESSION).parquet(path)
    stored = spark.read.schema(marked.schema).parquet(path)
    return stored.filter("NOT late").drop("late"), stored.filter("late").drop("late")


@query(
    "pipeline_gold",
    with_tables("sl_contracts", "sl_vehicles", "sl_stores")
    + """
SELECT prefecture, CAST(date_trunc('month', contract_date) AS DATE) AS sales_month, maker, count(*) AS units,
  round(sum(actual_price), 4) AS sales, round(sum(gross_profit), 4) AS gross_profit
FROM sl_contracts c LEFT JOIN sl_stores s ON c.store_id = s.store_id
LEFT JOIN sl_vehicles v ON c.vehicle_id = v.vehicle_id GROUP BY 1, 2, 3""",
)
def pipeline_gold(spark, t):
    """Contracts landed by day, through bronze and rules to silver, joined to stores and vehicles there, to a mart.

    Silver is stored by month; the second delivery recomputes the months it touches.
    """
    base = working_folder(spark, "pipeline")
    landing = f"{base}/landing"

    def mart(contracts):
        return contracts.groupBy("prefecture", "sales_month", "maker").agg(
            F.count(F.lit(1)).alias("units"),
            F.sum("actual_price").alias("sales"),
            F.sum("gross_profit").alias("gross_profit"),
        )

    done = -1
    with shuffles_released(spark):
        for delivery, folder in zip(_deliveries(spark, t, base), _DELIVERED):
            files.write_daily(delivery, "contract_date", landing)
            files.drop_partitions(spark, f"{base}/delivered", [folder])  # it lies in the landing folder now
            tables = run_medallion(spark, landing, base, CONTRACT_FEED, {})
            clean = spark.read.parquet(tables["silver"])
            newest = clean.filter(F.col("batch_id") > done)
            joined = silver.to_silver(
                newest, t["sl_stores"], t["sl_vehicles"], silver.BODY_TYPE_SPELLINGS, by_month=True
            )
            path = refresh.refresh_incremental(
                spark, joined.drop("sales_month"), base, f"after-{done}", mart=mart, name="contracts_by_maker", dealt=True
            )
            done = clean.agg(F.max("batch_id")).first()[0]
    return rounded(spark.read.parquet(path), {"sales": 4, "gross_profit": 4})


# Rows that the first delivery brings with a fault: no value, or a key that is no number.
_FAULTY, _MISNAMED = "event_id % 40 = 0", "event_id % 41 = 0"


def _two_deliveries(spark, t, purpose):
    """Events through all layers in two runs; returns the path of every table.

    The first delivery brings the earlier days with faults. The second brings
    all days in order, the earlier ones once more.
    """
    base = working_folder(spark, purpose)
    landing = f"{base}/landing"
    early = t["events"].filter(F.to_date("ts") < F.lit(_SECOND_DELIVERY)).withColumns(
        {
            "value": F.when(~F.expr(_FAULTY), F.col("value")),
            "event_id": F.when(F.expr(_MISNAMED), F.concat(F.lit("x"), "event_id")).otherwise(
                F.col("event_id").cast("string")
            ),
        }
    )
    for delivery in (early, t["events"]):
        files.write_daily(delivery, "ts", landing)
        paths = run_medallion(spark, landing, base, EVENT_FEED, {"event_daily": _daily_mart})
    return paths


@query(
    "medallion_gold",
    """
SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, round(sum(value), 4) AS value,
  count(DISTINCT user_id) AS users FROM events
WHERE event_type <> 'error' AND value IS NOT NULL GROUP BY 1, 2""",
)
def medallion_gold(spark, t):
    """Landed files through bronze and silver to a gold mart; corrected redeliveries count, repeats do not."""
    return rounded(spark.read.parquet(_two_deliveries(spark, t, "medallion")["event_daily"]), {"value": 4})


@query(
    "dq_stream_metrics",
    f"""
WITH delivered AS (
  SELECT {_MISNAMED} AS misnamed, CASE WHEN {_FAULTY} THEN NULL ELSE value END AS value, event_type
  FROM events WHERE CAST(ts AS DATE) < DATE '{_SECOND_DELIVERY}'
  UNION ALL SELECT false, value, event_type FROM events)
SELECT 'typed' AS rule, count(*) FILTER (WHERE NOT misnamed) AS passed, count(*) FILTER (WHERE misnamed) AS failed FROM delivered
UNION ALL SELECT 'value_present', count(value), count(*) - count(value) FROM delivered
UNION ALL SELECT 'no_error_events', count(*) FILTER (WHERE event_type <> 'error'),
  count(*) - count(*) FILTER (WHERE event_type <> 'error') FROM delivered""",
)
def dq_stream_metrics(spark, t):
    """Rows that met and violated each rule on the way to silver, over both deliveries as they came."""
    counted = spark.read.parquet(_two_deliveries(spark, t, "metrics")["quality"])
    return counted.groupBy("rule").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))


def _loaded_thrice(spark, t, purpose, **mart):
    """A first load with wrong months, a second load, and the first again with the right rows."""
    base = working_folder(spark, purpose)
    right, late = _deliveries(spark, t, base)
    wrong = right.withColumn("contract_date", F.add_months("contract_date", -240))
    for rows, batch in ((wrong, "first"), (late, "second"), (right, "first")):
        path = refresh.refresh_incremental(spark, rows, base, batch, **mart)
    return spark.read.parquet(path)


@query(
    "mv_incremental",
    with_tables("sl_contracts")
    + """
SELECT CAST(date_trunc('month', contract_date) AS DATE) AS sales_month, count(*) AS units,
  round(sum(actual_price), 4) AS sales, round(sum(gross_profit), 4) AS gross_profit,
  count(DISTINCT customer_id) AS customers,
  round(sum(gross_profit) / nullif(sum(actual_price), 0), 6) AS margin_rate
FROM sl_contracts GROUP BY 1""",
)
def incremental(spark, t):
    """A summary after three loads, one of them replacing an earlier one with other months, equals a full one."""
    summary = _loaded_thrice(spark, t, "refresh")
    return rounded(summary, {"sales": 4, "gross_profit": 4, "margin_rate": 6})


@query(
    "mv_incremental_store",
    with_tables("sl_contracts")
    + """
SELECT store_id, CAST(date_trunc('month', contract_date) AS DATE) AS sales_month, count(*) AS units,
  round(sum(actual_price), 4) AS sales, round(sum(gross_profit), 4) AS gross_profit
FROM sl_contracts GROUP BY 1, 2""",
)
def incremental_store(spark, t):
    """The store mart refreshed in the same way."""
    summary = _loaded_thrice(spark, t, "refresh-store", mart=refresh.store_summary, name="store_sales")
    return rounded(summary, {"sales": 4, "gross_profit": 4})


MONTHLY_BY_DELTAS = deltas.SignedMart(
    "monthly_by_deltas",
    sums={"sales": "actual_price", "gross_profit": "gross_profit"},
    distinct={"customers": "customer_id"},
    finish=lambda mart: mart.withColumn("margin_rate", ratio("gross_profit", "sales")),
)
STORES_BY_DELTAS = deltas.SignedMart(
    "stores_by_deltas", ("store_id",), sums={"sales": "actual_price", "gross_profit": "gross_profit"}
)


def _delivered_thrice(spark, t, purpose, mart):
    """The deliveries of ``_loaded_thrice``, each as a signed delta."""
    base = working_folder(spark, purpose)
    right, late = _deliveries(spark, t, base)
    wrong = right.withColumn("contract_date", F.add_months("contract_date", -240))
    for rows, batch in ((wrong, "first"), (late, "second"), (right, "first")):
        path = deltas.apply_load(spark, rows, base, batch, mart)
    return spark.read.parquet(path)


@query(
    "mv_signed",
    with_tables("sl_contracts")
    + """
SELECT CAST(date_trunc('month', contract_date) AS DATE) AS sales_month, count(*) AS units,
  round(sum(actual_price), 4) AS sales, round(sum(gross_profit), 4) AS gross_profit,
  count(DISTINCT customer_id) AS customers,
  round(sum(gross_profit) / nullif(sum(actual_price), 0), 6) AS margin_rate
FROM sl_contracts GROUP BY 1""",
)
def signed(spark, t):
    """The monthly summary kept up by signed deltas: a redelivery takes away what its batch had added."""
    summary = _delivered_thrice(spark, t, "signed", MONTHLY_BY_DELTAS)
    return rounded(summary, {"sales": 4, "gross_profit": 4, "margin_rate": 6})


@query(
    "mv_signed_store",
    with_tables("sl_contracts")
    + """
SELECT store_id, CAST(date_trunc('month', contract_date) AS DATE) AS sales_month, count(*) AS units,
  round(sum(actual_price), 4) AS sales, round(sum(gross_profit), 4) AS gross_profit
FROM sl_contracts GROUP BY 1, 2""",
)
def signed_store(spark, t):
    """The store mart kept up in the same way."""
    return rounded(_delivered_thrice(spark, t, "signed-store", STORES_BY_DELTAS), {"sales": 4, "gross_profit": 4})
