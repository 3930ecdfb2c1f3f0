"""The engine's operators as queries over a folder of test tables, each with its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moraine.functions.values import cosine, epoch_seconds
from moraine.operators import cdc, drift, expectations, gold, profile, reconcile, serving, silver
from moraine.registry import TABLES
from moraine.session import kept
from moraine.sources.entities import duckdb_view, entity, log_of, star

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
AS_OF = "1998-06-01"
SPLIT = 500  # events up to this number are the first batch


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: plain(f(spark, sf_dir))
        if sql:
            SQL[name] = sql
        return f

    return register


def plain(df: DataFrame) -> DataFrame:
    """Money as doubles and days as text, which every engine's client hands over alike."""
    kinds = {"decimal": "double", "date": "string"}
    return df.withColumns({c: F.col(c).cast(kinds[k.split("(")[0]]) for c, k in df.dtypes if k.split("(")[0] in kinds})


def _with(*views: str, more: str = "") -> str:
    """Entity views under names of their own: ``v_orders`` and so on."""
    return "WITH " + ", ".join(f"v_{v} AS ({duckdb_view(v)})" for v in views) + more


def _as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


# --- change data capture

_LATEST = "SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC) AS n FROM v_change_events {where}) WHERE n = 1"


@query("cdc_latest_state", _with("change_events") + f" SELECT user_id, event_type, value FROM ({_LATEST.format(where='')}) WHERE op <> 'd'")
def cdc_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest event of each key, deletes left out."""
    events = cdc.normalize(entity(spark, sf_dir, "change_events"), ["user_id", "event_type", "value"])
    return cdc.latest(events, "user_id").filter("op <> 'd'").select("user_id", "event_type", "value")


@query("cdc_normalize_envelope", _with("change_events") + " SELECT user_id, event_type, value, op, lsn, ts_ms FROM v_change_events WHERE op IS NOT NULL")
def cdc_normalize_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.normalize(log_of(entity(spark, sf_dir, "change_events")), ["user_id", "event_type", "value"])


def _merge_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = entity(spark, sf_dir, "change_events")
    columns = ["user_id", "event_type", "value"]
    first = cdc.latest(cdc.normalize(events.filter(F.col("lsn") <= SPLIT), columns), "user_id").filter("op <> 'd'").select(*columns)
    return cdc.merged(first, cdc.latest(cdc.normalize(events.filter(F.col("lsn") > SPLIT), columns), "user_id"), "user_id")


_MERGE = _with("change_events", more=f", t AS (SELECT * FROM ({_LATEST.format(where=f'WHERE lsn <= {SPLIT}')}) WHERE op <> 'd'), s AS ({_LATEST.format(where=f'WHERE lsn > {SPLIT}')})")


@query(
    "cdc_merge_state",
    _MERGE + " SELECT t.user_id, t.event_type, t.value FROM t ANTI JOIN s USING (user_id) UNION ALL SELECT user_id, event_type, value FROM s WHERE op <> 'd'",
)
def cdc_merge_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.survivors(_merge_frame(spark, sf_dir))


@query(
    "cdc_merge_metrics",
    _MERGE
    + """ SELECT count(*) FILTER (t.user_id IS NULL AND s.op <> 'd') AS inserted, count(*) FILTER (t.user_id IS NOT NULL AND s.op <> 'd') AS updated,
    count(*) FILTER (t.user_id IS NOT NULL AND s.op = 'd') AS deleted, count(*) FILTER (t.user_id IS NULL AND s.op = 'd') AS ignored
    FROM s LEFT JOIN t USING (user_id)""",
)
def cdc_merge_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.col("_action")
    return _merge_frame(spark, sf_dir).filter("_came").agg(F.count_if(a == "insert").alias("inserted"), F.count_if(a == "update").alias("updated"), F.count_if(a == "delete").alias("deleted"), F.count_if(a.isNull()).alias("ignored"))


@query("cdc_guarded_state", _with("change_events") + f" SELECT user_id, event_type, value FROM ({_LATEST.format(where='')}) WHERE op <> 'd'")
def cdc_guarded_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later half merged before the earlier one: with log positions kept, order across batches doesn't matter."""
    events, columns = entity(spark, sf_dir, "change_events"), ["user_id", "event_type", "value"]
    state = spark.createDataFrame([], "user_id long, event_type string, value double, _lsn long, _deleted boolean")
    for part in (events.filter(F.col("lsn") > SPLIT), events.filter(F.col("lsn") <= SPLIT)):
        changes = cdc.latest(cdc.normalize(part, columns), "user_id")
        state = cdc.survivors(cdc.merged(state, changes, "user_id", guard_lsn=True), guard_lsn=True)
    return state.filter("not _deleted").select(*columns)


# --- Silver

_CLEAN = {
    "customers": """SELECT * REPLACE (lower(trim(email)) AS email, CASE WHEN lower(trim(segment)) IN ('consumer', 'b2c', 'retail') THEN 'consumer'
        WHEN lower(trim(segment)) IN ('smb', 'sme', 'small', 'small business') THEN 'smb' WHEN lower(trim(segment)) IN ('enterprise', 'ent', 'corp', 'corporate') THEN 'enterprise'
        ELSE lower(trim(segment)) END AS segment) FROM v_customers""",
    "products": "SELECT * REPLACE (TRY_CAST(is_active AS BOOLEAN) AS is_active) FROM v_products",
    "orders": "SELECT *, CAST(round(quantity * unit_price, 2) AS DECIMAL(23,2)) AS total_amount FROM v_orders",
    "inventory": "SELECT * FROM v_inventory",
    "shipments": "SELECT * REPLACE (lower(trim(status)) AS status) FROM v_shipments",
}
_RULES = {
    "customers": ["invalid_email: NOT regexp_matches(email, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$')"],
    "products": ["null_is_active: is_active IS NULL"],
    "orders": ["non_positive_quantity: quantity <= 0", "negative_unit_price: unit_price < 0"],
    "inventory": ["negative_quantity: quantity < 0", "negative_reorder_point: reorder_point < 0"],
    "shipments": [
        "illegal_status: status NOT IN ('label_created', 'in_transit', 'delivered', 'returned')",
        "delivered_without_timestamp: status = 'delivered' AND delivered_at IS NULL",
        "shipped_without_timestamp: status IN ('in_transit', 'delivered') AND shipped_at IS NULL",
        "delivered_before_shipped: delivered_at < shipped_at",
    ],
}


_PAST = {"customers": "created_at updated_at", "products": "created_at", "orders": "created_at updated_at", "inventory": "updated_at", "shipments": "shipped_at delivered_at"}
_NEEDED = {
    "customers": "name email segment region created_at updated_at",
    "products": "name category unit_cost is_active created_at",
    "orders": "customer_id product_id quantity unit_price status channel created_at updated_at",
    "inventory": "product_id warehouse_id quantity reorder_point updated_at",
    "shipments": "order_id carrier status",
}
_KEYS = {"customers": "customer_id", "products": "product_id", "orders": "order_id", "inventory": "inventory_id", "shipments": "shipment_id"}


def _tagged_sql(table: str) -> str:
    key = _KEYS[table]
    future = " OR ".join(f"coalesce({c} > TIMESTAMP '{AS_OF}', false)" for c in _PAST[table].split())
    missing = " OR ".join(f"{c} IS NULL" for c in _NEEDED[table].split())
    rules = [f"null_primary_keys: {key} IS NULL", f"future_timestamps: {future}", f"type_consistency: {missing}", *_RULES[table], f"duplicate_pks: count(*) OVER (PARTITION BY {key}) > 1"]
    cases = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in (r.split(": ", 1) for r in rules))
    return _with(table, more=f", c AS ({_CLEAN[table]}), tagged AS (SELECT *, list_filter([{cases}], lambda x: x IS NOT NULL) AS v FROM c)")


_MONEY = {"orders": "REPLACE (unit_price::DOUBLE AS unit_price, total_amount::DOUBLE AS total_amount)", "products": "REPLACE (unit_cost::DOUBLE AS unit_cost)"}


def _silver(table: str) -> None:
    key = TABLES[table].primary_key

    def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
        return silver.tagged(table, entity(spark, sf_dir, table), as_of=_as_of())

    query(f"silver_{table}_clean", _tagged_sql(table) + f" SELECT * EXCLUDE (v) {_MONEY.get(table, '')} FROM tagged WHERE len(v) = 0")(lambda spark, d: rows(spark, d).filter(F.size("_violations") == 0).drop("_violations"))
    query(f"silver_{table}_quarantine", _tagged_sql(table) + f" SELECT {key}, array_to_string(v, ',') AS violations FROM tagged WHERE len(v) > 0")(
        lambda spark, d: rows(spark, d).filter(F.size("_violations") > 0).select(key, F.array_join("_violations", ",").alias("violations"))
    )
    query(f"silver_{table}_violation_histogram", _tagged_sql(table) + " SELECT violation, count(*) AS row_count FROM (SELECT unnest(v) AS violation FROM tagged) GROUP BY violation")(lambda spark, d: silver.violation_histogram(rows(spark, d)))


for _table in TABLES:
    _silver(_table)


# --- expectations

def _silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean("orders", entity(spark, sf_dir, "orders"))


def _row_expectation(name: str, table: str, make: Callable[[], expectations.RowExpectation], sql: str) -> None:
    column = expectations.UNEXPECTED

    def run(spark: SparkSession, d: DataFrame) -> DataFrame:
        return silver.clean(table, entity(spark, d, table)).agg(F.count_if(make().bad()).alias(column), F.count(F.lit(1)).alias("row_count"))

    query(name, _with(table, more=f", c AS ({_CLEAN[table]})") + f" SELECT count(*) FILTER ({sql}) AS {column}, count(*) AS row_count FROM c")(run)


_E = expectations
_row_expectation("expect_amounts", "orders", _E.ExpectOrderAmountsToMatchLineItems, "abs(total_amount - round(quantity * unit_price, 2)) > 0.01")
_row_expectation("expect_monotonic", "customers", lambda: _E.ExpectTimestampMonotonicity("customers"), "updated_at < created_at")
_row_expectation("expect_not_null", "products", lambda: _E.ExpectColumnValuesToNotBeNull("products", "is_active"), "is_active IS NULL")
_row_expectation("expect_in_set", "orders", lambda: _E.ExpectColumnValuesToBeInSet("orders", "channel", _E.CHANNELS), "channel NOT IN ('web', 'mobile', 'retail', 'partner')")
_row_expectation("expect_between", "orders", lambda: _E.ExpectColumnValuesToBeBetween("orders", "quantity", 5, 40), "quantity < 5 OR quantity > 40")
_row_expectation("expect_inventory_non_negative", "inventory", _E.ExpectInventoryNonNegative, "quantity < 0")


@query("expect_unique", _with("orders") + " SELECT order_id, count(*) AS copies FROM v_orders GROUP BY order_id HAVING count(*) > 1")
def expect_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expectations.ExpectColumnValuesToBeUnique("orders", "order_id").duplicated(entity(spark, sf_dir, "orders"))


@query("expect_no_orphans", _with("orders", "customers") + " SELECT order_id, customer_id FROM v_orders ANTI JOIN (SELECT customer_id FROM v_customers WHERE customer_id % 10 <> 0) p USING (customer_id)")
def expect_no_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = entity(spark, sf_dir, "customers").filter("customer_id % 10 <> 0")
    return expectations.ExpectNoOrphanedOrders.orphans(entity(spark, sf_dir, "orders").select("order_id", "customer_id"), parents, "customer_id").select("order_id", "customer_id")


_SUITE_SQL = _with("orders", "customers", "products", more=f", c AS ({_CLEAN['orders']})") + """
SELECT * FROM (
  SELECT 'orders' AS table_name, 'ExpectColumnValuesToNotBeNull(order_id)' AS expectation, 0 AS position, (SELECT count(*) FROM c WHERE order_id IS NULL) AS unexpected UNION ALL
  SELECT 'orders', 'ExpectColumnValuesToBeUnique(order_id)', 1, (SELECT count(*) FROM (SELECT order_id FROM c GROUP BY 1 HAVING count(*) > 1)) UNION ALL
  SELECT 'orders', 'ExpectColumnValuesToBeInSet(status)', 2, (SELECT count(*) FROM c WHERE status NOT IN ('pending', 'confirmed', 'shipped', 'delivered', 'cancelled')) UNION ALL
  SELECT 'orders', 'ExpectColumnValuesToBeInSet(channel)', 3, (SELECT count(*) FROM c WHERE channel NOT IN ('web', 'mobile', 'retail', 'partner')) UNION ALL
  SELECT 'orders', 'ExpectColumnValuesToBeBetween(quantity)', 4, (SELECT count(*) FROM c WHERE quantity < 1) UNION ALL
  SELECT 'orders', 'ExpectColumnValuesToBeBetween(unit_price)', 5, (SELECT count(*) FROM c WHERE unit_price < 0) UNION ALL
  SELECT 'orders', 'ExpectOrderAmountsToMatchLineItems', 6, (SELECT count(*) FROM c WHERE abs(total_amount - round(quantity * unit_price, 2)) > 0.01) UNION ALL
  SELECT 'orders', 'ExpectNoOrphanedOrders', 7, (SELECT count(*) FROM c ANTI JOIN v_customers USING (customer_id)) + (SELECT count(*) FROM c ANTI JOIN v_products USING (product_id))
)"""


@query("quality_orders_suite", _SUITE_SQL)
def quality_orders_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _suite(spark, "silver_orders_suite", _checked_orders(spark, sf_dir))


def _checked_orders(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The orders with what their suite looks at, made once for all its passes, and their parents."""
    columns = ["order_id", "customer_id", "product_id", "quantity", "unit_price", "status", "channel", "total_amount", "created_at"]
    return {"orders": kept(_silver_orders(spark, sf_dir).select(*columns)), "customers": entity(spark, sf_dir, "customers").select("customer_id"), "products": entity(spark, sf_dir, "products").select("product_id")}


def _suite(spark: SparkSession, name: str, tables: dict[str, DataFrame]) -> DataFrame:
    """A whole suite: row-wise checks fused, the others on their own. One small row per expectation comes back."""
    checks, _ = expectations.SUITES[name]
    rows = [(r.table, r.expectation, i, r.unexpected) for i, r in enumerate(expectations.validate(expectations.ValidationContext(tables), checks))]
    return spark.createDataFrame(rows, "table_name string, expectation string, position int, unexpected long")


@query(
    "quality_customers_suite",
    _with("customers", more=f", c AS ({_CLEAN['customers']})")
    + """
SELECT * FROM (
  SELECT 'customers' AS table_name, 'ExpectColumnValuesToNotBeNull(customer_id)' AS expectation, 0 AS position, (SELECT count(*) FROM c WHERE customer_id IS NULL) AS unexpected UNION ALL
  SELECT 'customers', 'ExpectColumnValuesToBeUnique(customer_id)', 1, (SELECT count(*) FROM (SELECT customer_id FROM c GROUP BY 1 HAVING count(*) > 1)) UNION ALL
  SELECT 'customers', 'ExpectColumnValuesToNotBeNull(email)', 2, (SELECT count(*) FROM c WHERE email IS NULL) UNION ALL
  SELECT 'customers', 'ExpectColumnValuesToBeInSet(segment)', 3, (SELECT count(*) FROM c WHERE segment NOT IN ('consumer', 'smb', 'enterprise')) UNION ALL
  SELECT 'customers', 'ExpectColumnValuesToBeInSet(region)', 4, (SELECT count(*) FROM c WHERE region NOT IN ('NA', 'EMEA', 'APAC', 'LATAM')) UNION ALL
  SELECT 'customers', 'ExpectTimestampMonotonicity(customers)', 5, (SELECT count(*) FROM c WHERE updated_at < created_at)
)""",
)
def quality_customers_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _suite(spark, "silver_customers_suite", {"customers": silver.clean("customers", entity(spark, sf_dir, "customers"))})


_INVENTORY_SUITE = (
    _with("inventory")
    + """
SELECT * FROM (
  SELECT 'inventory' AS table_name, 'ExpectColumnValuesToNotBeNull(inventory_id)' AS expectation, 0 AS position, (SELECT count(*) FROM v_inventory WHERE inventory_id IS NULL) AS unexpected UNION ALL
  SELECT 'inventory', 'ExpectColumnValuesToBeUnique(inventory_id)', 1, (SELECT count(*) FROM (SELECT inventory_id FROM v_inventory GROUP BY 1 HAVING count(*) > 1)) UNION ALL
  SELECT 'inventory', 'ExpectInventoryNonNegative', 2, (SELECT count(*) FROM v_inventory WHERE quantity < 0)
)"""
)


@query("quality_inventory_suite", _INVENTORY_SUITE)
def quality_inventory_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _suite(spark, "silver_inventory_suite", {"inventory": entity(spark, sf_dir, "inventory")})


_OLD_ORDERS = "1995-01-01"


@query(
    "quality_latest_run",
    f"""WITH o AS ({_SUITE_SQL}), i AS ({_INVENTORY_SUITE})
SELECT suite, run_id, count(*) FILTER (unexpected = 0) AS passed, count(*) AS total, bool_and(unexpected = 0) AS success
FROM (SELECT 'silver_orders_suite' AS suite, 'second' AS run_id, unexpected FROM o UNION ALL SELECT 'silver_inventory_suite', 'only', unexpected FROM i) GROUP BY ALL""",
)
def quality_latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the orders, the first when only those before 1995 were there, and one over the inventory: the newest of each suite."""
    tables = _checked_orders(spark, sf_dir)
    runs = [
        ("silver_orders_suite", "first", 1, tables | {"orders": tables["orders"].filter(F.col("created_at") < F.lit(_OLD_ORDERS).cast("timestamp_ntz"))}),
        ("silver_orders_suite", "second", 2, tables),
        ("silver_inventory_suite", "only", 1, {"inventory": entity(spark, sf_dir, "inventory")}),
    ]
    out = None
    for suite, run_id, at, tables in runs:
        found = expectations.SuiteResult(suite, run_id, expectations.validate(expectations.ValidationContext(tables), expectations.SUITES[suite][0]))
        rows = expectations.results_frame(spark, found, F.timestamp_seconds(F.lit(at)))
        out = rows if out is None else out.unionByName(rows)
    return serving.quality(out)


@query("latest_event_per_user", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def latest_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.newest_per(star(spark, sf_dir, "events"), "user_id", F.desc("ts"), F.desc("event_id")).select("user_id", "event_id", "event_type")


# --- Gold

_STAGED = ", o AS (SELECT *, CAST(created_at AS DATE) AS order_date FROM (SELECT * REPLACE (lower(status) AS status, lower(channel) AS channel) FROM (" + _CLEAN["orders"] + ")))"
# Half up in whole cents, as Spark rounds decimals; DuckDB divides decimals as doubles.
_MEAN = "((2 * CAST(sum(total_amount) * 100 AS BIGINT) + count(total_amount)) // (2 * count(total_amount)))::DOUBLE / 100"
_DAILY = f"""SELECT order_date::VARCHAR AS revenue_date, count(*) AS order_count, count(DISTINCT customer_id) AS unique_customers, sum(total_amount)::DOUBLE AS gross_revenue,
  sum(CASE WHEN status = 'cancelled' THEN total_amount ELSE 0 END)::DOUBLE AS cancelled_revenue,
  sum(CASE WHEN status <> 'cancelled' THEN total_amount ELSE 0 END)::DOUBLE AS net_revenue, {_MEAN} AS avg_order_value
FROM o {{where}} GROUP BY order_date"""


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.stage_orders(_silver_orders(spark, sf_dir))


@query("gold_revenue_daily", _with("orders", more=_STAGED) + _DAILY.format(where=""))
def gold_revenue_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.revenue_daily(_orders(spark, sf_dir))


@query("gold_revenue_daily_incremental", _with("orders", more=_STAGED) + _DAILY.format(where="WHERE order_date >= DATE '1996-01-01'"))
def gold_revenue_daily_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.revenue_daily(_orders(spark, sf_dir), since=F.lit("1996-01-01").cast("date"))


_SEGMENTS = f"""SELECT c.customer_id, c.segment, c.region, count(o.order_id) AS lifetime_orders, coalesce(sum(total_amount), 0)::DOUBLE AS lifetime_value,
  coalesce({_MEAN}, 0) AS avg_order_value, max(o.created_at) AS last_order_at
FROM ({_CLEAN['customers']}) c LEFT JOIN o ON c.customer_id = o.customer_id {{where}} GROUP BY c.customer_id, c.segment, c.region"""


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.stage_customers(silver.clean("customers", entity(spark, sf_dir, "customers")))


@query("gold_customer_segments", _with("orders", "customers", more=_STAGED) + _SEGMENTS.format(where=""))
def gold_customer_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.customer_segments(_customers(spark, sf_dir), _orders(spark, sf_dir))


@query("gold_customer_segments_incremental", _with("orders", "customers", more=_STAGED) + _SEGMENTS.format(where="WHERE c.customer_id IN (SELECT customer_id FROM o WHERE created_at >= TIMESTAMP '1998-07-01')"))
def gold_customer_segments_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.customer_segments(_customers(spark, sf_dir), _orders(spark, sf_dir), since=F.lit("1998-07-01").cast("timestamp_ntz"))


@query(
    "gold_inventory_health",
    _with("inventory", "products")
    + """ SELECT i.product_id, p.name AS product_name, lower(p.category) AS category, CAST(sum(i.quantity) AS BIGINT) AS total_on_hand, min(i.reorder_point) AS reorder_point,
  count(DISTINCT i.warehouse_id) AS warehouse_count, CASE WHEN sum(i.quantity) = 0 THEN 'OUT_OF_STOCK' WHEN max(CASE WHEN i.quantity <= i.reorder_point THEN 1 ELSE 0 END) = 1 THEN 'REORDER' ELSE 'HEALTHY' END AS health_status
FROM v_inventory i JOIN v_products p ON i.product_id = p.product_id GROUP BY i.product_id, p.name, p.category""",
)
def gold_inventory_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.inventory_health(gold.stage_inventory(entity(spark, sf_dir, "inventory")), gold.stage_products(entity(spark, sf_dir, "products")))


_RECON = "SELECT 'orders' AS table_name, 7 AS source_rows, false AS count_match, CAST(NULL AS BOOLEAN) AS checksum_match, 3 AS sample_mismatches, 'COUNT_MISMATCH' AS reconciliation_status, 'v2' AS schema_version"
_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, (SELECT count(*) FROM v_{t}) AS target_rows" for t in TABLES)
_SUMMARY = f"""SELECT table_name, CAST(source_rows AS DOUBLE) AS source_rows, target_rows, CAST(coalesce(source_rows, target_rows) - target_rows AS BIGINT) AS row_delta, coalesce(count_match, false) AS count_match,
  CAST(checksum_match AS VARCHAR) AS checksum_match, CAST(coalesce(sample_mismatches, 0) AS BIGINT) AS sample_mismatches, coalesce(reconciliation_status, 'PENDING') AS reconciliation_status, coalesce(schema_version, 'v1') AS schema_version
FROM ({_COUNTS}) LEFT JOIN ({_RECON}) USING (table_name)"""


@query("gold_migration_summary", _with(*TABLES) + _SUMMARY)
def gold_migration_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    recon = spark.sql(_RECON + ", CAST(NULL AS TIMESTAMP) AS reconciled_at").withColumn("source_rows", F.col("source_rows").cast("long"))
    return gold.migration_summary({t: entity(spark, sf_dir, t) for t in TABLES}, recon).drop("last_synced_at").withColumns({"source_rows": F.col("source_rows").cast("double"), "checksum_match": F.col("checksum_match").cast("string")})


@query("gold_migration_scorecard", _with(*TABLES) + f" SELECT count(*) AS tables, 0::BIGINT AS reconciled, count(*) FILTER (reconciliation_status = 'PENDING') AS pending, CAST(sum(target_rows) AS BIGINT) AS target_rows, CAST(sum(row_delta) AS BIGINT) AS row_delta, 'DEGRADED' AS verdict FROM ({_SUMMARY})")
def gold_migration_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.scorecard(gold_migration_summary(spark, sf_dir))


@query("recon_statuses", _with(*TABLES) + f" SELECT table_name, reconciliation_status FROM ({_SUMMARY})")
def recon_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.recon_statuses(gold_migration_summary(spark, sf_dir))


@query(
    "quality_gold_suite",
    _with("orders", "customers", more=_STAGED + f", r AS ({_DAILY.format(where='')}), g AS ({_SEGMENTS.format(where='')})")
    + """
SELECT * FROM (
  SELECT 'gold_revenue_daily' AS table_name, 'ExpectColumnValuesToBeUnique(revenue_date)' AS expectation, 0 AS position, (SELECT count(*) FROM (SELECT revenue_date FROM r GROUP BY 1 HAVING count(*) > 1)) AS unexpected UNION ALL
  SELECT 'gold_revenue_daily', 'ExpectColumnValuesToBeBetween(order_count)', 1, (SELECT count(*) FROM r WHERE order_count < 1) UNION ALL
  SELECT 'gold_customer_segments', 'ExpectColumnValuesToBeUnique(customer_id)', 2, (SELECT count(*) FROM (SELECT customer_id FROM g GROUP BY 1 HAVING count(*) > 1)) UNION ALL
  SELECT 'gold_customer_segments', 'ExpectColumnValuesToBeBetween(lifetime_orders)', 3, (SELECT count(*) FROM g WHERE lifetime_orders < 0)
)""",
)
def quality_gold_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _suite(spark, "gold_suite", {"gold_revenue_daily": gold_revenue_daily(spark, sf_dir), "gold_customer_segments": gold_customer_segments(spark, sf_dir)})


# --- staging

for _name, _sql in {
    "orders": "SELECT * REPLACE (lower(status) AS status, lower(channel) AS channel, unit_price::DOUBLE AS unit_price), CAST(CAST(created_at AS DATE) AS VARCHAR) AS order_date FROM v_orders",
    "customers": "SELECT * REPLACE (lower(email) AS email, lower(segment) AS segment) FROM v_customers",
    "products": "SELECT * REPLACE (lower(category) AS category, unit_cost::DOUBLE AS unit_cost) FROM v_products",
    "inventory": "SELECT *, quantity <= reorder_point AS needs_reorder FROM v_inventory",
}.items():
    query(f"stg_{_name}", _with(_name) + _sql)(lambda spark, d, n=_name: gold.STAGING[n](entity(spark, d, n)))


# --- reconciliation

def _unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, each number once. Rows are few a number: they go to their group's task as they are, and are put in order there only."""
    columns = TABLES["orders"].columns
    rows = entity(spark, sf_dir, "orders").repartition("order_id")
    return rows.groupBy("order_id").agg(*[F.min(c).alias(c) for c in columns if c != "order_id"]).select(*columns)


def _copy(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Unique orders, and a copy with rows missing, a changed status, prices and times off by little and by much, and one row more."""
    source = _unique(spark, sf_dir)
    k = F.col("order_id")
    price = F.col("unit_price") + F.when(k % 7 == 0, F.lit("0.005")).when(k % 11 == 0, F.lit("0.05")).otherwise(F.lit("0")).cast("decimal(12,3)")
    time = F.when(k % 5 == 0, F.col("created_at") + F.expr("INTERVAL '0.5' SECOND")).when(k % 13 == 0, F.col("created_at") + F.expr("INTERVAL '5' SECOND")).otherwise(F.col("created_at"))
    target = source.filter(k % 1000 != 1).withColumns({"status": F.when(k % 97 == 0, "lost").otherwise(F.col("status")), "unit_price": price, "created_at": time})
    return source, target


_COPY = _with(
    "orders",
    more=""", s AS (SELECT order_id, min(customer_id) AS customer_id, min(product_id) AS product_id, min(quantity) AS quantity, min(unit_price) AS unit_price, min(status) AS status, min(channel) AS channel,
  min(created_at) AS created_at, min(updated_at) AS updated_at FROM v_orders GROUP BY order_id),
t AS (SELECT * REPLACE (CASE WHEN order_id % 97 = 0 THEN 'lost' ELSE status END AS status, unit_price + CASE WHEN order_id % 7 = 0 THEN 0.005 WHEN order_id % 11 = 0 THEN 0.05 ELSE 0 END AS unit_price,
  CASE WHEN order_id % 5 = 0 THEN created_at + INTERVAL 500 MILLISECONDS WHEN order_id % 13 = 0 THEN created_at + INTERVAL 5 SECONDS ELSE created_at END AS created_at) FROM s WHERE order_id % 1000 <> 1)""",
)
_HASH = "('0x' || substr(md5(concat_ws('|', order_id, customer_id, product_id, quantity, status, channel)), 1, 15))::BIGINT::HUGEINT"
_DIFF = """(SELECT s.order_id, t.order_id IS NULL AS missing_in_target, CASE WHEN t.order_id IS NULL THEN '' ELSE array_to_string(list_filter([CASE WHEN s.unit_price IS NULL OR abs(s.unit_price - t.unit_price) > 0.01 THEN 'unit_price' END,
  CASE WHEN s.status <> t.status THEN 'status' END, CASE WHEN abs(epoch(s.created_at) - epoch(t.created_at)) > 1 THEN 'created_at' END], lambda x: x IS NOT NULL), ',') END AS fields
FROM {source} s LEFT JOIN t USING (order_id))"""
_SAMPLED = "(SELECT * FROM s ORDER BY md5(order_id::VARCHAR), order_id LIMIT 1000)"


@query("recon_counts", _COPY + " SELECT (SELECT count(*) FROM s) AS source_count, (SELECT count(*) FROM t) AS target_count")
def recon_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, t = _copy(spark, sf_dir)
    return s.agg(F.count(F.lit(1)).alias("source_count")).crossJoin(t.agg(F.count(F.lit(1)).alias("target_count")))  # one row each


@query("recon_checksum", _COPY + f" SELECT count(*) AS source_count, CAST(sum({_HASH}) AS VARCHAR) AS source_checksum FROM s")
def recon_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.side_stats(_copy(spark, sf_dir)[0], list(TABLES["orders"].checksum), "source")


@query("recon_sample", _COPY + f" SELECT order_id FROM {_SAMPLED}")
def recon_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.sample(_copy(spark, sf_dir)[0].select("order_id"), "order_id")


@query("recon_sample_diff", _COPY + f" SELECT * FROM {_DIFF.format(source=_SAMPLED)} WHERE missing_in_target OR fields <> ''")
def recon_sample_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, t = _copy(spark, sf_dir)
    return reconcile.sample_diff(s, t, "order_id", TABLES["orders"].columns).withColumn("fields", F.array_join("fields", ","))


@query("recon_full_diff", _COPY + f" SELECT order_id, CASE WHEN missing_in_target THEN 'missing_in_target' ELSE 'different' END AS kind, fields FROM {_DIFF.format(source='s')} WHERE missing_in_target OR fields <> ''")
def recon_full_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, t = _copy(spark, sf_dir)
    return reconcile.full_diff(s, t, "order_id", TABLES["orders"].columns).withColumn("fields", F.array_join("fields", ","))


@query(
    "recon_status",
    _COPY
    + f""", c AS (SELECT (SELECT count(*) FROM s) AS source_count, (SELECT count(*) FROM t) AS target_count, (SELECT CAST(sum({_HASH}) AS VARCHAR) FROM s) AS source_checksum, (SELECT CAST(sum({_HASH}) AS VARCHAR) FROM t) AS target_checksum,
  (SELECT count(*) FROM {_DIFF.format(source=_SAMPLED)} WHERE missing_in_target OR fields <> '') AS sample_mismatches)
SELECT 'orders' AS table_name, source_count, target_count, source_count = target_count AS count_match, source_checksum, target_checksum,
  CASE WHEN abs(source_count - target_count) / source_count < 0.01 THEN source_checksum = target_checksum END AS checksum_match, least(source_count, 1000) AS sample_size, sample_mismatches, CASE WHEN source_count <> target_count THEN 'COUNT_MISMATCH'
  WHEN source_checksum <> target_checksum THEN 'CHECKSUM_MISMATCH' WHEN sample_mismatches > 0 THEN 'SAMPLE_MISMATCH' ELSE 'RECONCILED' END AS status FROM c""",
)
def recon_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, t = _copy(spark, sf_dir)
    return reconcile.reconciled(s, t, TABLES["orders"]).drop("discrepancies")


# --- profiles, catalog, vectors

def _profile_sql(table: str, columns: dict[str, str]) -> str:
    parts = []
    for c, kind in columns.items():
        mean = f"avg({c}::DOUBLE)" if kind in ("int", "bigint") else "NULL::DOUBLE"
        parts.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, '{kind}' AS data_type, count(*) AS row_count, count(*) FILTER ({c} IS NULL) AS null_count, count(*) FILTER ({c} IS NULL) / count(*) AS null_rate, count(DISTINCT {c}) AS distinct_count, min({c})::VARCHAR AS min_value, max({c})::VARCHAR AS max_value, {mean} AS mean_value FROM p")
    return " UNION ALL ".join(parts)


_PROFILED = {"shipment_id": "bigint", "order_id": "bigint", "carrier": "string", "status": "string"}


@query("profile_columns", _with("shipments", more=", p AS (SELECT * FROM v_shipments) ") + _profile_sql("shipments", _PROFILED))
def profile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile(entity(spark, sf_dir, "shipments").select(*_PROFILED), "shipments", exact=True, samples=False)


def _samples_sql(c: str) -> str:
    """The five parts of the hash space and the value hashed lowest in each."""
    return f"(SELECT string_agg(v, ',' ORDER BY h) FROM (SELECT md5({c}::VARCHAR) AS h, {c}::VARCHAR AS v FROM p WHERE {c} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY ('0x' || h[32])::INT % 5 ORDER BY h) = 1))"


#: The entities' columns as they come: ``is_active`` is text before it is cleaned.
_COLUMNS = {t: {f.split()[0]: f.split()[1] for f in TABLES[t].ddl.replace("is_active boolean", "is_active string").split(", ")} for t in TABLES}
_NUMBERS = ("int", "bigint", "decimal(12,2)")


def _whole_profile_sql(table: str) -> str:
    parts = []
    for c, kind in _COLUMNS[table].items():
        mean = f"round(avg({c}::DOUBLE), 6)" if kind in _NUMBERS else "NULL::DOUBLE"
        parts.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, '{kind}' AS data_type, count(*) AS row_count, count(*) FILTER ({c} IS NULL) AS null_count, count(*) FILTER ({c} IS NULL) / count(*) AS null_rate, true AS distinct_close, min({c})::VARCHAR AS min_value, max({c})::VARCHAR AS max_value, {mean} AS mean_value, coalesce({_samples_sql(c)}, '') AS sample_values FROM p")
    return f"SELECT * FROM (WITH p AS MATERIALIZED (SELECT * FROM v_{table}) {' UNION ALL '.join(parts)})"


@query("profile_approximate", _with(*TABLES) + " " + " UNION ALL ".join(_whole_profile_sql(t) for t in TABLES))
def profile_approximate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As the profiler runs it, for every entity: sample values, and approximate distinct counts, told as whether they are within three standard errors."""
    out = None
    for t in TABLES:
        df = entity(spark, sf_dir, t)
        p = profile.profile(df, t, samples=False).join(F.broadcast(profile.sampled(df)), "column_name")
        out = p if out is None else out.unionByName(p)
    close = F.abs(F.col("distinct_count") - F.col("exact")) <= 3 * 0.05 * F.col("exact") + 1
    return out.withColumns({"distinct_close": close, "mean_value": F.round("mean_value", 6), "sample_values": F.array_join("sample_values", ",")}).drop("distinct_count", "exact")


_DOCUMENTS = """SELECT row_number() OVER (ORDER BY kind, table_name, column_name NULLS LAST) - 1 AS doc_id, * FROM (
  SELECT 'column' AS kind, table_name, column_name, 'Table ' || table_name || ', column ' || column_name || ' (' || data_type || '). Represents ' || replace(column_name, '_', ' ') || ' in the ' || table_name || ' table. Cardinality ' || distinct_count || ', null rate 0.0%.' AS text FROM q UNION ALL
  SELECT 'table', table_name, NULL, 'Table ' || table_name || ' contains columns: ' || string_agg(column_name, ', ' ORDER BY column_name) || '. It holds ' || table_name || ' records in the migrated warehouse.' FROM q GROUP BY table_name)"""


@query("catalog_documents", _with("shipments", more=f", p AS (SELECT * FROM v_shipments), q AS ({_profile_sql('shipments', _PROFILED)}) ") + _DOCUMENTS)
def catalog_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.catalog_documents(profile_columns(spark, sf_dir).withColumn("sample_values", F.lit(None).cast("array<string>")))


@query("catalog_search")
def catalog_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = profile.index_documents(catalog_documents(spark, sf_dir))
    return profile.search(index, "carrier of a shipment")


@query("vector_topk", "SELECT vec_id, label, round(list_cosine_similarity(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 7)), 4) AS score FROM embeddings ORDER BY list_cosine_similarity(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 7)) DESC, vec_id LIMIT 5")
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows most like one of them: the query is a scalar subquery, and the ranking a top-k."""
    e = star(spark, sf_dir, "embeddings")
    q = e.filter("vec_id = 7").select(F.col("embedding").alias("q"))
    return e.join(F.broadcast(q)).withColumn("s", cosine(F.col("embedding"), F.col("q"))).orderBy(F.desc("s"), "vec_id").limit(5).select("vec_id", "label", F.round("s", 4).alias("score"))  # one row against all


# --- lag, drift, serving

_LAG = "SELECT event_type, CAST(event_id % 1000 + user_id AS BIGINT) AS lag_ms FROM events"


@query("lag_percentiles", f"WITH l AS ({_LAG}), n AS (SELECT event_type, lag_ms, row_number() OVER (PARTITION BY event_type ORDER BY lag_ms) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM l), p AS (SELECT unnest([50, 95, 99]) AS percent) SELECT event_type, percent::INT AS percent, lag_ms AS value FROM n, p WHERE i = round_even(percent / 100 * (n - 1), 0)")
def lag_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.percentile(star(spark, sf_dir, "events").selectExpr("event_type", "CAST(event_id % 1000 + user_id AS BIGINT) AS lag_ms"), "lag_ms", [50, 95, 99], ["event_type"])


@query("lag_summary", f"SELECT count(*) AS events, min(lag_ms) AS min_lag, max(lag_ms) AS max_lag, avg(lag_ms) AS mean_lag FROM ({_LAG})")
def lag_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.lag(star(spark, sf_dir, "events").selectExpr("CAST(event_id % 1000 + user_id AS BIGINT) AS lag_ms"), "lag_ms")


#: A table as it was and as it is: keys and counts retyped, one column renamed, one gone, one new.
_ALTERED = {
    "l_orderkey": "l_orderkey", "l_partkey": "CAST(l_partkey AS INT)", "l_suppkey": "CAST(l_suppkey AS SMALLINT)", "l_linenumber": "CAST(l_linenumber AS BIGINT)", "l_quantity": "CAST(l_quantity AS INT)",
    "l_extendedprice": "CAST(l_extendedprice AS DECIMAL(14,1))", "discount_rate": "l_discount", "l_returnflag": "l_returnflag", "l_linestatus": "l_linestatus", "l_shipdate": "l_shipdate", "l_channel": "l_returnflag",
}
_NARROW = "CAST(l_extendedprice AS DECIMAL(12,2)) AS l_extendedprice"
_KINDS = [("BIGINT", "bigint", "INTEGER", 64, 0), ("INTEGER", "int", "INTEGER", 32, 0), ("SMALLINT", "smallint", "INTEGER", 16, 0), ("DOUBLE", "double", "FLOAT", 64, 0), ("VARCHAR", "string", "STRING", 10**9, 0), ("TIMESTAMP", "timestamp_ntz", "TIMESTAMP", 0, 0), ("DECIMAL(12,2)", "decimal(12,2)", "DECIMAL", 12, 2), ("DECIMAL(14,1)", "decimal(14,1)", "DECIMAL", 14, 1)]
# The rules of drift over both schemas as DuckDB describes them. Names are compared by their longest common part, which is all that these pairs have in common.
_DRIFT = f"""WITH k AS (SELECT * FROM (VALUES {", ".join(map(str, _KINDS))}) t(kind, s, f, r, d)),
o AS (SELECT column_name AS c, k.* FROM (DESCRIBE SELECT * REPLACE ({_NARROW}) FROM lineitem) JOIN k ON kind = column_type),
n AS (SELECT column_name AS c, k.* FROM (DESCRIBE SELECT {", ".join(f"{e} AS {c}" for c, e in _ALTERED.items())} FROM lineitem) JOIN k ON kind = column_type),
came AS (SELECT * FROM n WHERE c NOT IN (SELECT c FROM o)), went AS (SELECT * FROM o WHERE c NOT IN (SELECT c FROM n)),
alike AS (SELECT came.c, went.c AS was, went.s AS from_type, came.s AS to_type, max(b - a + 1) AS longest
  FROM came JOIN went USING (f, r, d), UNNEST(range(1, 20)) AS x(a), UNNEST(range(1, 20)) AS y(b) WHERE b >= a AND b <= length(went.c) AND contains(came.c, went.c[a:b]) GROUP BY ALL),
pairs AS (SELECT c, was, from_type, to_type FROM alike WHERE 2.0 * longest / (length(c) + length(was)) >= 0.6),
changes AS (
  SELECT n.c, CASE WHEN n.f <> o.f THEN 'TYPE_CHANGED' WHEN n.r >= o.r AND n.d >= o.d THEN 'TYPE_WIDENED' ELSE 'TYPE_NARROWED' END AS t, o.s AS from_type, n.s AS to_type, NULL AS was FROM n JOIN o USING (c) WHERE (n.f, n.r, n.d) <> (o.f, o.r, o.d)
  UNION ALL SELECT c, 'RENAMED', from_type, to_type, was FROM pairs
  UNION ALL SELECT c, 'ADDED', NULL, s, NULL FROM came WHERE c NOT IN (SELECT c FROM pairs)
  UNION ALL SELECT c, 'DROPPED', s, NULL, NULL FROM went WHERE c NOT IN (SELECT was FROM pairs)),
graded AS (SELECT *, CASE WHEN t IN ('ADDED', 'TYPE_WIDENED') THEN 'NON_BREAKING' WHEN t = 'RENAMED' THEN 'AMBIGUOUS' ELSE 'BREAKING' END AS g FROM changes)
SELECT 'lineitem' AS table_name, c AS column_name, t AS change_type, g AS severity, (SELECT CASE WHEN bool_or(g = 'BREAKING') THEN 'halt' WHEN bool_or(g = 'AMBIGUOUS') THEN 'review' WHEN count(*) > 0 THEN 'auto_evolve' ELSE 'none' END FROM graded) AS action,
  from_type, to_type, was AS renamed_from, row_number() OVER (ORDER BY g <> 'BREAKING', c) AS place FROM graded"""


def _drifted(spark: SparkSession, sf_dir: str) -> drift.DriftReport:
    was = star(spark, sf_dir, "lineitem").withColumn("l_extendedprice", F.col("l_extendedprice").cast("decimal(12,2)"))
    now = star(spark, sf_dir, "lineitem").selectExpr(*[f"{e} AS {c}" for c, e in _ALTERED.items()])
    return drift.classify_drift(drift.schema_of(now), drift.schema_of(was), "lineitem")


@query("drift_report", _DRIFT)
def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed between a table and its altered copy, by their schemas."""
    report = _drifted(spark, sf_dir)
    place = F.create_map(*[F.lit(x) for k, c in enumerate(report.changes, 1) for x in (c.column, k)])
    return drift.report_frame(spark, report).drop("detail", "detected_at").withColumn("place", place[F.col("column_name")].cast("long"))


@query("drift_by_severity", f"SELECT severity, count(*) AS events FROM ({_DRIFT}) GROUP BY severity")
def drift_by_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.drift_by_severity(drift.report_frame(spark, _drifted(spark, sf_dir)))


@query("drift_events_ranked", f"SELECT column_name, severity, row_number() OVER (ORDER BY CASE severity WHEN 'BREAKING' THEN 0 WHEN 'AMBIGUOUS' THEN 1 ELSE 2 END, column_name) AS place FROM ({_DRIFT})")
def drift_events_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drift page's order: gravest first, the newest (here all alike) next."""
    from pyspark.sql import Window as W

    events = drift.report_frame(spark, _drifted(spark, sf_dir)).withColumn("detected_at", F.timestamp_seconds(F.lit(0)))
    return events.select("column_name", "severity", F.row_number().over(W.orderBy(*serving.drift_order())).cast("long").alias("place"))  # a row a change


@query("epoch_of_text", "SELECT event_id, epoch(ts) AS seconds FROM events")
def epoch_of_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times written as ISO text and read back as seconds."""
    from pyspark.sql.types import StringType

    return star(spark, sf_dir, "events").select("event_id", epoch_seconds(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), StringType()).alias("seconds"))
