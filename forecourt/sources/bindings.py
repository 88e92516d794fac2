"""Binds the star-schema parquet tables to the logical business tables.

Each logical table is one SELECT over the parquet tables, used in Spark
(``LogicalTables``) and in the SQL checks (``with_tables``). Amounts are exact
and cast to DOUBLE last, which keeps row values identical across engines.
Contracts have a second text for Spark that sums scaled integers.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARQUET_TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# The reference date standing in for "today" on the test data.
AS_OF = dt.date(2001, 8, 1)

# Parquet tables each logical table reads, and its SELECT.
_LOGICAL: dict[str, tuple[tuple[str, ...], str]] = {
    "sl_stores": (
        ("supplier", "nation", "region"),
        """
SELECT s_suppkey AS store_id, s_name AS store_name, n_name AS prefecture, r_name AS format
FROM {supplier} LEFT JOIN {nation} ON s_nationkey = n_nationkey
LEFT JOIN {region} ON n_regionkey = r_regionkey""",
    ),
    "sl_vehicles": (
        ("part",),
        """
SELECT p_partkey AS vehicle_id,
  CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE p_partkey % 10 END AS store_id,
  p_brand AS maker, p_name AS model, p_type AS body_type,
  CAST(2001 - p_size % 15 AS INT) AS model_year, CAST(p_size * 2500 AS INT) AS mileage_km,
  CASE WHEN p_partkey % 41 = 0 THEN NULL ELSE p_size % 3 = 0 END AS certified,
  CASE WHEN p_partkey % 5 = 0 THEN 'あり' ELSE 'なし' END AS repair_history,
  p_retailprice AS listing_price,
  CAST(CAST(p_retailprice AS DECIMAL(12,2))
    * CASE WHEN p_partkey % 20 = 0 THEN 1.05 ELSE 0.80 END AS DOUBLE) AS purchase_price,
  lpad(CAST(p_partkey AS VARCHAR(20)), CASE WHEN p_partkey % 50 = 0 THEN 16 ELSE 17 END, '0') AS vin,
  concat('P-', CAST(p_partkey AS VARCHAR(20))) AS plate_number,
  CAST(DATE '2000-01-01' + CAST(p_partkey % 500 AS INT) AS DATE) AS stocked_date,
  CASE p_partkey % 4 WHEN 0 THEN '在庫中' WHEN 1 THEN '商談中' WHEN 2 THEN '成約済' ELSE '出庫済' END AS status
FROM {part}""",
    ),
    "sl_customers": (
        ("customer", "nation"),
        """
SELECT c_custkey AS customer_id, c_name AS name, c_custkey % 10 AS registered_store_id,
  n_name AS area, c_mktsegment AS segment, c_acctbal AS budget,
  concat('090-', lpad(CAST(c_custkey % 10000 AS VARCHAR(20)), 4, '0'), '-',
    lpad(CAST((c_custkey * 7) % 10000 AS VARCHAR(20)), 4, '0')) AS phone
FROM {customer} LEFT JOIN {nation} ON c_nationkey = n_nationkey""",
    ),
    "sl_inquiries": (
        ("orders",),
        """
SELECT o_orderkey AS inquiry_id, CAST(o_orderdate AS DATE) AS inquiry_date,
  o_custkey AS customer_id, o_orderkey % 10 AS store_id, o_orderkey % 200 AS vehicle_id,
  o_orderpriority AS channel,
  CASE o_orderstatus WHEN 'F' THEN '成約' WHEN 'O' THEN '失注' ELSE '進行中' END AS status
FROM {orders}""",
    ),
    "sl_contracts": (
        ("lineitem", "orders", "part"),
        """
SELECT g.l_orderkey * 10 + g.l_linenumber AS contract_id, g.l_orderkey AS inquiry_id,
  CAST(o_orderdate AS DATE) AS contract_date, o_custkey AS customer_id, g.store_id, g.vehicle_id,
  CAST(g.net AS DOUBLE) AS actual_price,
  CAST(g.net - g.qty * CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS gross_profit
FROM (SELECT l_orderkey, l_linenumber, min(l_suppkey) AS store_id, min(l_partkey) AS vehicle_id,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))
          * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DECIMAL(18,4)) AS net,
        CAST(sum(l_quantity) AS DECIMAL(8,0)) AS qty
      FROM {lineitem} GROUP BY l_orderkey, l_linenumber) g
LEFT JOIN {orders} ON g.l_orderkey = o_orderkey
LEFT JOIN {part} ON g.vehicle_id = p_partkey""",
    ),
    "sl_market_index": (
        ("lineitem", "part"),
        """
SELECT CAST(l_shipdate AS DATE) AS date, p_type AS vehicle_category,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) / sum(l_quantity) AS market_index
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
GROUP BY CAST(l_shipdate AS DATE), p_type""",
    ),
    "sl_notes": (
        ("conversations",),
        """
SELECT conv_id AS note_id, turn, role, text FROM {conversations} WHERE role IS DISTINCT FROM 'system'""",
    ),
}


# Sums of DECIMAL products need more than 18 digits, which Spark adds as objects.
# Hundredths as BIGINT give the same amounts: price and discount in hundredths
# make a net amount in ten-thousandths.
_SPARK_CONTRACTS = """
SELECT g.l_orderkey * 10 + g.l_linenumber AS contract_id, g.l_orderkey AS inquiry_id,
  CAST(o_orderdate AS DATE) AS contract_date, o_custkey AS customer_id, g.store_id, g.vehicle_id,
  net / 10000D AS actual_price,
  (net - qty * CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 100 AS BIGINT) * 100) / 10000D AS gross_profit
FROM (SELECT l_orderkey, l_linenumber, min(l_suppkey) AS store_id, min(l_partkey) AS vehicle_id,
        sum(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT)
          * (100 - CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS BIGINT))) AS net,
        CAST(round(sum(l_quantity)) AS BIGINT) AS qty
      FROM {lineitem} GROUP BY l_orderkey, l_linenumber) g
LEFT JOIN {orders} ON g.l_orderkey = o_orderkey
LEFT JOIN {part} ON g.vehicle_id = p_partkey"""


class LogicalTables(dict):
    """Logical (and raw) tables by name, each built on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__()
        self.spark, self.folder = spark, folder

    def contracts_between(self, start: dt.date, end: dt.date) -> DataFrame:
        """Contracts dated from ``start`` up to, not including, ``end``.

        The date lies in another table than the amounts. Orders are filtered first and amounts of other
        orders dropped before they are added up, so the aggregate and its shuffle hold the period only.
        """
        dated = self["orders"].filter(
            (F.col("o_orderdate") >= F.lit(start)) & (F.col("o_orderdate") < F.lit(end))
        )
        own = F.col("l_orderkey") == F.col("o_orderkey")
        amounts = self["lineitem"].join(dated.select("o_orderkey"), own, "left_semi")
        return self.spark.sql(_SPARK_CONTRACTS, lineitem=amounts, orders=dated, part=self["part"])

    def __missing__(self, name: str) -> DataFrame:
        if name in PARQUET_TABLES:
            frame = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        elif name in _LOGICAL:
            inputs, text = _LOGICAL[name]
            if name == "sl_contracts":
                text = _SPARK_CONTRACTS
            frame = self.spark.sql(text, **{table: self[table] for table in inputs})
        else:
            raise KeyError(name)
        self[name] = frame
        return frame


def with_tables(*names: str) -> str:
    """``WITH`` clause giving the named logical tables to a plain SQL text."""
    ctes = []
    for name in names:
        inputs, text = _LOGICAL[name]
        ctes.append(f"{name} AS ({text.format(**{table: table for table in inputs})})")
    return "WITH " + ",\n".join(ctes)
