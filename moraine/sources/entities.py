"""The moved tables as views over a folder of star-schema Parquet files.

Bronze rows on purpose: spellings to clean, rows that break rules, repeated keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CUSTOMERS = """
SELECT c_custkey AS customer_id, c_name AS name,
  CASE WHEN c_custkey % 17 = 0 THEN c_name ELSE concat(' ', replace(c_name, '#', '.'), '@Example.com ') END AS email,
  CASE c_mktsegment WHEN 'BUILDING' THEN ' B2C ' WHEN 'AUTOMOBILE' THEN 'SME' WHEN 'MACHINERY' THEN 'Corp' WHEN 'HOUSEHOLD' THEN 'consumer' ELSE c_mktsegment END AS segment,
  CASE r_name WHEN 'AMERICA' THEN 'NA' WHEN 'EUROPE' THEN 'EMEA' WHEN 'MIDDLE EAST' THEN 'EMEA' WHEN 'ASIA' THEN 'APAC' ELSE r_name END AS region,
  {created} AS created_at, {updated} AS updated_at
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

PRODUCTS = """
SELECT p_partkey AS product_id, p_name AS name, p_type AS category, CAST(p_retailprice AS DECIMAL(12,2)) AS unit_cost,
  CASE p_size % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE 'maybe' END AS is_active, {created} AS created_at
FROM part"""

ORDERS = """
SELECT l_orderkey * 10 + l_linenumber AS order_id, o_custkey AS customer_id, l_partkey AS product_id, CAST(l_quantity AS INT) AS quantity,
  CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price,
  CASE WHEN l_returnflag = 'R' THEN 'Cancelled' WHEN o_orderstatus = 'F' THEN 'Delivered' WHEN o_orderstatus = 'O' THEN 'Pending' ELSE 'Confirmed' END AS status,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'web' WHEN '2' THEN 'mobile' WHEN '3' THEN 'Retail' WHEN '4' THEN 'partner' ELSE 'fax' END AS channel,
  o_orderdate AS created_at, l_shipdate AS updated_at
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""

INVENTORY = """
SELECT l_partkey * 1000000 + l_suppkey AS inventory_id, l_partkey AS product_id, CAST(l_suppkey % 10 AS INT) AS warehouse_id,
  CAST(sum(l_quantity) - 20 AS INT) AS quantity, CAST(10 AS INT) AS reorder_point, max(l_shipdate) AS updated_at
FROM lineitem GROUP BY l_partkey, l_suppkey"""

SHIPMENTS = """
SELECT l_orderkey * 10 + l_linenumber AS shipment_id, l_orderkey AS order_id,
  CASE l_linenumber % 4 WHEN 0 THEN 'ups' WHEN 1 THEN 'fedex' WHEN 2 THEN 'usps' ELSE 'dhl' END AS carrier,
  CASE WHEN l_returnflag = 'R' THEN ' Returned' WHEN l_returnflag = 'A' THEN 'DELIVERED' WHEN l_linestatus = 'O' THEN 'in_transit' ELSE 'teleported' END AS status,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE l_shipdate END AS shipped_at,
  CASE WHEN l_returnflag = 'A' AND CAST(l_quantity AS INT) % 5 <> 0 THEN {delivered} END AS delivered_at, {estimated} AS estimated_delivery
FROM lineitem"""

EVENTS = """
SELECT user_id, event_type, value, CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op, event_id AS lsn, CAST(0 AS BIGINT) AS ts_ms
FROM events"""

_SPARK = {
    "customers": (CUSTOMERS, {"created": "CAST(date_add(DATE '1992-01-01', CAST(c_custkey % 1000 AS INT)) AS TIMESTAMP_NTZ)", "updated": "CAST(date_add(DATE '1992-01-01', CAST(c_custkey % 1000 + c_custkey % 5 - 1 AS INT)) AS TIMESTAMP_NTZ)"}),
    "products": (PRODUCTS, {"created": "CAST(date_add(DATE '1992-01-01', CAST(p_partkey % 1000 AS INT)) AS TIMESTAMP_NTZ)"}),
    "orders": (ORDERS, {}),
    "inventory": (INVENTORY, {}),
    "shipments": (SHIPMENTS, {"delivered": "l_shipdate + make_dt_interval(CAST(l_quantity AS INT) % 7 - 1)", "estimated": "l_shipdate + make_dt_interval(10)"}),
    "change_events": (EVENTS, {}),
}
_DUCKDB = {
    "customers": {"created": "CAST(DATE '1992-01-01' + CAST(c_custkey % 1000 AS INT) AS TIMESTAMP)", "updated": "CAST(DATE '1992-01-01' + CAST(c_custkey % 1000 + c_custkey % 5 - 1 AS INT) AS TIMESTAMP)"},
    "products": {"created": "CAST(DATE '1992-01-01' + CAST(p_partkey % 1000 AS INT) AS TIMESTAMP)"},
    "shipments": {"delivered": "l_shipdate + to_days(CAST(l_quantity AS INT) % 7 - 1)", "estimated": "l_shipdate + to_days(10)"},
}
_READS = {
    "customers": ("customer", "nation", "region"),
    "products": ("part",),
    "orders": ("lineitem", "orders", "part"),
    "inventory": ("lineitem",),
    "shipments": ("lineitem",),
    "change_events": ("events",),
}


def entity(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the views, planned from the files; nothing is stored or registered."""
    text, parts = _SPARK[name]
    sql = text.format(**parts)
    return spark.sql("WITH " + ", ".join(f"{t} AS (SELECT * FROM {{{t}}})" for t in _READS[name]) + sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _READS[name]})


def duckdb_view(name: str) -> str:
    """The same view's SQL for DuckDB."""
    return _SPARK[name][0].format(**_DUCKDB.get(name, {}))


def star(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def log_of(events: DataFrame) -> DataFrame:
    """Flat change events as an envelope: the row before a delete, the row after anything else."""
    row = F.struct(*[F.col(c) for c in events.columns if c not in ("op", "lsn", "ts_ms")])
    return events.select("op", F.when(F.col("op") == "d", row).alias("before"), F.when(F.col("op") != "d", row).alias("after"), F.struct("lsn", "ts_ms").alias("source"), "ts_ms")
