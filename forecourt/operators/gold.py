"""Gold marts: sales, inventory, market-linked margin, margin score, customer segments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.operators.joins import BROADCAST_BYTES, broadcast_if_small, fits_broadcast

def month_of(date: str) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(date, "MM")


def ratio(part: str, whole: str) -> Column:
    """``part / whole``, NULL where the whole is zero."""
    return F.col(part) / F.nullif(F.col(whole), F.lit(0))


def store_monthly_sales(contracts: DataFrame) -> DataFrame:
    """Units, sales and gross profit; key (store_id, sales_month)."""
    return contracts.groupBy("store_id", month_of("contract_date").alias("sales_month")).agg(
        F.count(F.lit(1)).alias("units"),
        F.sum("actual_price").alias("sales"),
        F.sum("gross_profit").alias("gross_profit"),
    )


def monthly_sales(contracts: DataFrame) -> DataFrame:
    """Units, sales, gross profit and margin rate; key sales_month."""
    return (
        contracts.groupBy(month_of("contract_date").alias("sales_month"))
        .agg(
            F.count(F.lit(1)).alias("units"),
            F.sum("actual_price").alias("sales"),
            F.sum("gross_profit").alias("gross_profit"),
        )
        .withColumn("margin_rate", ratio("gross_profit", "sales"))
    )


def dashboard_kpi(contracts: DataFrame) -> DataFrame:
    """Monthly figures and one grand total (``sales_month`` NULL, ``is_total``).

    Rows are first reduced to (month, customer), so the distinct count and the
    two grouping levels work on that instead of on the contracts.
    """
    per_customer = contracts.groupBy(
        month_of("contract_date").alias("sales_month"), "customer_id"
    ).agg(
        F.count(F.lit(1)).alias("units"),
        F.sum("actual_price").alias("sales"),
        F.sum("gross_profit").alias("gross_profit"),
    )
    return (
        per_customer.rollup("sales_month")
        .agg(
            (F.grouping("sales_month") == 1).alias("is_total"),
            F.sum("units").alias("units"),
            F.sum("sales").alias("sales"),
            F.sum("gross_profit").alias("gross_profit"),
            F.count_distinct("customer_id").alias("customers"),
        )
        .withColumn("margin_rate", ratio("gross_profit", "sales"))
    )


def inventory_summary(vehicles: DataFrame) -> DataFrame:
    """Stock by (body_type, status)."""
    return vehicles.groupBy("body_type", "status").agg(
        F.count(F.lit(1)).alias("vehicles"),
        F.avg("listing_price").alias("avg_listing_price"),
        F.sum("listing_price").alias("listing_total"),
        F.sum("purchase_price").alias("purchase_total"),
    )


def sales_by_vehicle_attribute(
    contracts: DataFrame,
    vehicles: DataFrame,
    attribute: str,
    *keys: Column | str,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Units, sales and gross profit by ``keys`` and one attribute of the vehicle.

    If the vehicles fit a broadcast, contracts are joined where they lie and
    only the totals are shuffled. Otherwise contracts are summed per (keys,
    vehicle) before the join, so a vehicle with very many contracts reaches the
    join as few rows.
    """
    side = vehicles.select("vehicle_id", attribute)
    totals = [
        F.count(F.lit(1)).alias("units"),
        F.sum("actual_price").alias("sales"),
        F.sum("gross_profit").alias("gross_profit"),
    ]
    if fits_broadcast(side, broadcast_bytes):
        joined = contracts.join(F.broadcast(side), "vehicle_id", "left")
        return joined.groupBy(*keys, attribute).agg(*totals)
    per_vehicle = contracts.groupBy(*keys, "vehicle_id").agg(*totals)
    names = per_vehicle.columns[: len(keys)]
    return (
        per_vehicle.join(side, "vehicle_id", "left")
        .groupBy(*names, attribute)
        .agg(*(F.sum(c).alias(c) for c in ("units", "sales", "gross_profit")))
    )


def monthly_index(market_index: DataFrame) -> DataFrame:
    """Mean market index by (month, category)."""
    return market_index.groupBy(
        month_of("date").alias("month"), F.col("vehicle_category").alias("category")
    ).agg(F.avg("market_index").alias("market_index"))


def market_linked_margin(
    contracts: DataFrame, vehicles: DataFrame, market_index: DataFrame
) -> DataFrame:
    """Market index next to the margin rate; key (month, category)."""
    sales = sales_by_vehicle_attribute(
        contracts, vehicles, "body_type", month_of("contract_date").alias("month")
    )
    return (
        sales.withColumnRenamed("body_type", "category")
        .withColumn("margin_rate", ratio("gross_profit", "sales"))
        .join(monthly_index(market_index), ["month", "category"])
    )


def margin_score(contracts: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Standard score of each contract's margin rate within month, store and category.

    (rate - mean) / population standard deviation; NULL where all rates are the
    same. Group statistics are aggregated and joined back: a window would move
    every contract of a large group into one task.
    """
    group = ["month", "store_id", "category"]
    side = vehicles.select("vehicle_id", F.col("body_type").alias("category"))
    side = broadcast_if_small({"vehicle": side})["vehicle"]
    rated = contracts.join(side, "vehicle_id", "left").select(
        "contract_id",
        month_of("contract_date").alias("month"),
        "store_id",
        "category",
        ratio("gross_profit", "actual_price").alias("margin_rate"),
    )
    stats = (
        rated.groupBy(*group)
        .agg(F.avg("margin_rate").alias("mean"), F.stddev_pop("margin_rate").alias("spread"))
        .select(*(F.col(c).alias(f"g_{c}") for c in group), "mean", "spread")
    )
    same_group = [F.col(c).eqNullSafe(F.col(f"g_{c}")) for c in group]
    return rated.join(stats, same_group, "left").select(
        "contract_id",
        *group,
        "margin_rate",
        ((F.col("margin_rate") - F.col("mean")) / F.nullif("spread", F.lit(0.0))).alias("score"),
    )


# Recency in whole months since the last contact, value in cumulative sales.
# The band limits are this project's choice.
RECENCY_BANDS = ((6, "R1"), (12, "R2"), (24, "R3"))
RECENCY_BEYOND, NEVER = "R4", "R0"
VALUE_BANDS = ((1_500_000, "M1"), (2_500_000, "M2"))
VALUE_BEYOND = "M3"


def rm_segment(
    customers: DataFrame, inquiries: DataFrame, contracts: DataFrame, as_of: dt.date
) -> DataFrame:
    """Customers by months since last contact and cumulative purchase value.

    Contact is the latest inquiry or contract. Both facts are reduced to one row
    per customer before they meet the customer table.
    """
    last = inquiries.groupBy("customer_id").agg(F.max("inquiry_date").alias("last_inquiry"))
    value = contracts.groupBy("customer_id").agg(
        F.sum("actual_price").alias("value"),
        F.count(F.lit(1)).alias("contracts"),
        F.max("contract_date").alias("last_contract"),
    )
    last_contact = F.greatest("last_inquiry", "last_contract")  # ignores NULL
    months = F.floor(F.months_between(F.lit(as_of), last_contact)).cast("int")
    recency = F.when(F.col("months_since").isNull(), NEVER)
    for limit, label in RECENCY_BANDS:
        recency = recency.when(F.col("months_since") <= limit, label)
    worth = F
    for limit, label in VALUE_BANDS:
        worth = worth.when(F.col("total_value") < limit, label)
    return (
        customers.select("customer_id")
        .join(last, "customer_id", "left")
        .join(value, "customer_id", "left")
        .select(
            "customer_id",
            months.alias("months_since"),
            F.coalesce("value", F.lit(0.0)).alias("total_value"),
            F.coalesce("contracts", F.lit(0)).alias("n_contracts"),
        )
        .withColumns(
            {
                "recency_band": recency.otherwise(RECENCY_BEYOND),
                "value_band": worth.otherwise(VALUE_BEYOND),
            }
        )
        .withColumn("rm_segment", F.concat("recency_band", F.lit("-"), "value_band"))
    )


# CTE text of the same mart for the SQL checks; needs the three silver tables before it.
RM_SEGMENT_SQL = """rm AS (
  SELECT customer_id, months_since, total_value, n_contracts, recency_band, value_band,
    recency_band || '-' || value_band AS rm_segment
  FROM (SELECT *,
      CASE WHEN months_since IS NULL THEN 'R0' WHEN months_since <= 6 THEN 'R1'
        WHEN months_since <= 12 THEN 'R2' WHEN months_since <= 24 THEN 'R3' ELSE 'R4' END AS recency_band,
      CASE WHEN total_value < 1500000 THEN 'M1' WHEN total_value < 2500000 THEN 'M2' ELSE 'M3' END AS value_band
    FROM (SELECT c.customer_id, CAST(datesub('month', greatest(l.last_contact, v.last_contract), DATE '2001-08-01') AS INT) AS months_since,
        coalesce(v.value, 0.0) AS total_value, coalesce(v.contracts, 0) AS n_contracts
      FROM sl_customers c
      LEFT JOIN (SELECT customer_id, max(inquiry_date) AS last_contact FROM sl_inquiries GROUP BY 1) l
        ON c.customer_id = l.customer_id
      LEFT JOIN (SELECT customer_id, sum(actual_price) AS value, count(*) AS contracts, max(contract_date) AS last_contract
        FROM sl_contracts GROUP BY 1) v ON c.customer_id = v.customer_id)))"""
