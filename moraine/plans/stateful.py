"""Queries over what the engine keeps between runs: logs, trees, sketches and states, made from the test tables and read back.

They register beside those of ``plans.queries``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from moraine.operators import cdc, expectations, gold, hash_tree, lineage, profile, reconcile, revenue_state, serving
from moraine.plans.queries import _COPY, _DAILY, _DIFF, _LATEST, _PROFILED, _STAGED, _SUITE_SQL, _SUMMARY, _checked_orders, _copy, _profile_sql, _samples_sql, _silver_orders, _unique, _with, gold_migration_summary, query
from moraine.registry import TABLES
from moraine.session import kept, scratch
from moraine.sources.change_log import append_log, read_log
from moraine.sources.entities import entity, log_of, star
from moraine.sources.versioned import VersionedTable
from moraine.streaming.ingest import decode_json
from moraine.streaming.versions import decode_versions, frame

USER = ["user_id", "event_type", "value"]


def _logged(spark: SparkSession, sf_dir: str, value=None) -> str:
    """The change events as messages of a log, appended in two goes; returns its path."""
    path = scratch(spark)
    events = log_of(entity(spark, sf_dir, "change_events"))
    keyed = events.select(F.coalesce("before.user_id", "after.user_id").alias("k"), F.col("source.lsn").alias("o"), "*")
    for part in (keyed.filter("o % 2 = 0"), keyed.filter("o % 2 = 1")):
        body = F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"})
        append_log(part.withColumn("v", body if value is None else value(body)), path, key="k", value="v", order="o")
    return path


@query("change_log_state", _with("change_events") + f" SELECT user_id, event_type, value FROM ({_LATEST.format(where='')}) WHERE op <> 'd'")
def change_log_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest state of each key from a partitioned log, read whole."""
    row = entity(spark, sf_dir, "change_events").select(*USER).schema
    events = decode_json(read_log(spark, _logged(spark, sf_dir)), row)
    return cdc.latest(cdc.normalize(events, USER), "user_id").filter("op <> 'd'").select(*USER)


@query("change_log_offsets", "SELECT count(*) AS messages, count(*) AS places, 0::BIGINT AS tombstones FROM events")
def change_log_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message has a place of its own, and a partition's places have no gaps."""
    log = read_log(spark, _logged(spark, sf_dir))
    each = log.groupBy("partition").agg(F.count(F.lit(1)).alias("n"), (F.max("offset") - F.min("offset") + 1).alias("span"), F.count_if(F.col("value").isNull()).alias("t"))
    return each.agg(F.sum("n").alias("messages"), F.sum("span").alias("places"), F.sum("t").alias("tombstones"))


@query("schema_versions_state", _with("change_events") + f" SELECT user_id, event_type, CASE WHEN lsn % 3 = 0 THEN NULL ELSE value END AS value FROM ({_LATEST.format(where='')}) WHERE op <> 'd'")
def schema_versions_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of two schemas in one log: every third event's writer doesn't know ``value`` yet."""
    row = entity(spark, sf_dir, "change_events").select(*USER).schema
    old = row.fieldNames()[:2]
    first = type(row)([row[c] for c in old])
    framed = lambda body: F.when(F.col("o") % 3 == 0, frame(1, body)).otherwise(frame(2, body))
    events = decode_versions(read_log(spark, _logged(spark, sf_dir, framed)), {1: first, 2: row}, row)
    return cdc.latest(cdc.normalize(events, USER), "user_id").filter("op <> 'd'").select(*USER)


# --- reconciliation by trees

_FEW = _with(
    "orders",
    more=""", s AS (SELECT order_id, min(customer_id) AS customer_id, min(product_id) AS product_id, min(quantity) AS quantity, min(unit_price) AS unit_price, min(status) AS status, min(channel) AS channel,
  min(created_at) AS created_at, min(updated_at) AS updated_at FROM v_orders GROUP BY order_id),
t AS (SELECT * REPLACE (CASE WHEN order_id % 997 = 0 THEN 'lost' ELSE status END AS status, unit_price + CASE WHEN order_id % 1501 = 0 THEN 0.005 WHEN order_id % 1499 = 0 THEN 0.05 ELSE 0 END AS unit_price) FROM s WHERE order_id % 1013 <> 1
  UNION ALL SELECT * REPLACE (-order_id AS order_id) FROM s WHERE order_id % 2003 = 3)""",
)


@query(
    "recon_tree_diff",
    _FEW
    + """ SELECT coalesce(s.order_id, t.order_id) AS order_id, CASE WHEN t.order_id IS NULL THEN 'missing_in_target' WHEN s.order_id IS NULL THEN 'extra_in_target' ELSE 'different' END AS kind,
  CASE WHEN s.order_id IS NULL OR t.order_id IS NULL THEN '' ELSE array_to_string(list_filter([CASE WHEN abs(s.unit_price - t.unit_price) > 0.01 THEN 'unit_price' END, CASE WHEN s.status <> t.status THEN 'status' END], lambda x: x IS NOT NULL), ',') END AS fields
FROM s FULL JOIN t ON s.order_id = t.order_id WHERE s.order_id IS NULL OR t.order_id IS NULL OR abs(s.unit_price - t.unit_price) > 0.01 OR s.status <> t.status""",
)
def recon_tree_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full difference that opens unequal branches only: few rows missing, changed, or new."""
    columns, k = TABLES["orders"].columns, F.col("order_id")
    source = kept(_unique(spark, sf_dir))
    price = F.col("unit_price") + F.when(k % 1501 == 0, F.lit("0.005")).when(k % 1499 == 0, F.lit("0.05")).otherwise(F.lit("0")).cast("decimal(12,3)")
    changed = source.filter(k % 1013 != 1).withColumns({"status": F.when(k % 997 == 0, "lost").otherwise(F.col("status")), "unit_price": price})
    extra = source.filter(k % 2003 == 3).withColumns({"order_id": -k, "unit_price": F.col("unit_price").cast(changed.schema["unit_price"].dataType)})
    return hash_tree.diff_by_tree(source, changed.unionByName(extra), "order_id", columns, scratch(spark)).withColumn("fields", F.array_join("fields", ","))


# --- profiles that merge

_MERGED = {**_PROFILED, "shipped_at": "timestamp_ntz"}


@query(
    "profile_merged_versions",
    _with("shipments", more=", p AS (SELECT * FROM v_shipments) ")
    + f"SELECT table_name, column_name, data_type, row_count, null_count, null_rate, CASE WHEN data_type = 'timestamp_ntz' THEN strftime(min_value::TIMESTAMP, '%Y-%m-%d %H:%M:%S') ELSE min_value END AS min_value, CASE WHEN data_type = 'timestamp_ntz' THEN strftime(max_value::TIMESTAMP, '%Y-%m-%d %H:%M:%S') ELSE max_value END AS max_value, round(mean_value, 6) AS mean_value, true AS distinct_close FROM ({_profile_sql('shipments', _MERGED)})",
)
def profile_merged_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three versions' stored sketches merged, and how far the merged estimate is from the exact count: at most three standard errors."""
    path, rows = scratch(spark), entity(spark, sf_dir, "shipments").select(*_MERGED)
    for v in range(3):
        profile.store_sketches(rows.filter(F.col("shipment_id") % 3 == v), "shipments", str(v), path)
    merged = profile.merged_profile(VersionedTable(spark, path).read())
    exact = rows.agg(*[F.count_distinct(c).alias(c) for c in _MERGED]).select(F.explode(F.create_map(*[x for c in _MERGED for x in (F.lit(c), F.col(c))])).alias("column_name", "exact"))
    near = F.abs(F.col("distinct_count") - F.col("exact")) <= 3 * 1.04 / (1 << profile.LG_REGISTERS) ** 0.5 * F.col("exact") + 1
    return merged.join(F.broadcast(exact), "column_name").withColumns({"distinct_close": near, "mean_value": F.round("mean_value", 6)}).drop("distinct_count", "exact")


_SAMPLED = " UNION ALL ".join(f"SELECT '{c}' AS column_name, {_samples_sql(c)} AS sample_values" for c in _PROFILED)


@query("profile_samples", _with("shipments", more=", p AS (SELECT * FROM v_shipments) ") + _SAMPLED)
def profile_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample values of the profile's one aggregation."""
    rows = profile.profile(entity(spark, sf_dir, "shipments").select("shipment_id", "order_id", "carrier", "status"), "shipments")
    return rows.select("column_name", F.array_join("sample_values", ",").alias("sample_values"))


# --- marts from state

@query("gold_revenue_from_state", _with("orders", more=_STAGED) + _DAILY.format(where=""))
def gold_revenue_from_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily mart from bitmaps and sums, after three appends that share days."""
    orders = gold.stage_orders(_silver_orders(spark, sf_dir))
    parts = [orders.filter(F.pmod(F.col("order_id"), F.lit(3)) == k) for k in range(3)]
    return revenue_state.revenue_daily_of(revenue_state.rebuilt(spark, scratch(spark), parts))


@query("gold_revenue_since_mark", _with("orders", more=_STAGED) + _DAILY.format(where="WHERE order_date >= (SELECT max(order_date) FROM o WHERE order_date < DATE '1997-01-01')"))
def gold_revenue_since_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mart that has seen 1996 rebuilds: the mark is a scalar subquery inside the plan."""
    orders = gold.stage_orders(_silver_orders(spark, sf_dir))
    mark = orders.filter("order_date < DATE '1997-01-01'").agg(F.max("order_date")).scalar()
    return gold.revenue_daily(orders, since=mark)


# --- lineage

@query(
    "lineage_reach",
    """WITH RECURSIVE edges AS (
  SELECT 'region ' || n_regionkey AS parent, 'nation ' || n_nationkey AS child FROM nation
  UNION ALL SELECT 'nation ' || c_nationkey, 'customer ' || c_custkey FROM customer
  UNION ALL SELECT 'customer ' || o_custkey, 'order ' || o_orderkey FROM orders),
below AS (SELECT parent AS root, child AS node, 1 AS depth FROM edges WHERE starts_with(parent, 'region') UNION ALL SELECT root, child, depth + 1 FROM below JOIN edges ON node = parent)
SELECT root, depth, count(DISTINCT node) AS nodes FROM below GROUP BY ALL""",
)
def lineage_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much hangs on each region, level by level, along edges read from the tables' keys."""
    links = (("nation", "region", "n_regionkey", "nation", "n_nationkey"), ("customer", "nation", "c_nationkey", "customer", "c_custkey"), ("orders", "customer", "o_custkey", "order", "o_orderkey"))
    edges = reduce(DataFrame.union, [star(spark, sf_dir, t).selectExpr(f"concat('{a} ', {x}) AS parent", f"concat('{b} ', {y}) AS child") for t, a, x, b, y in links])
    roots = star(spark, sf_dir, "region").selectExpr("concat('region ', r_regionkey) AS root")
    return lineage.reach(edges, roots).groupBy("root", "depth").agg(F.count(F.lit(1)).alias("nodes"))


# --- pages

@query("overview_rows", _with(*TABLES) + f" SELECT table_name, source_rows, target_rows, row_delta, reconciliation_status AS status FROM ({_SUMMARY})")
def overview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = gold_migration_summary(spark, sf_dir).withColumn("last_synced_at", F.current_timestamp())
    return serving.overview(summary).drop("last_synced_at")


@query("quality_details_ranked", f"SELECT expectation, unexpected = 0 AS success, row_number() OVER (ORDER BY unexpected = 0, expectation) AS place FROM ({_SUITE_SQL})")
def quality_details_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A suite's newest results, failures first."""
    suite = "silver_orders_suite"
    tables = _checked_orders(spark, sf_dir)
    found = expectations.SuiteResult(suite, "only", expectations.validate(expectations.ValidationContext(tables), expectations.SUITES[suite][0]))
    rows = serving.quality_details(expectations.results_frame(spark, found), suite)
    return rows.select("expectation", "success", F.row_number().over(W.orderBy("success", "expectation")).cast("long").alias("place"))  # a row an expectation


@query("recon_discrepancies", _COPY + f" SELECT order_id::VARCHAR AS key, missing_in_target, fields FROM {_DIFF.format(source='(SELECT * FROM s ORDER BY md5(order_id::VARCHAR), order_id LIMIT 1000)')} WHERE missing_in_target OR fields <> '' ORDER BY order_id LIMIT 20")
def recon_discrepancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The differences that a report keeps: the first ``reconcile.STORED`` by key."""
    s, t = _copy(spark, sf_dir)
    kept = reconcile.reconciled(s, t, TABLES["orders"]).select(F.inline("discrepancies"))
    return kept.withColumn("fields", F.array_join("fields", ","))
