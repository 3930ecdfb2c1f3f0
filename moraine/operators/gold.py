"""Staging views and Gold marts, rebuilt in full or incrementally."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moraine.operators.cdc import upsert
from moraine.sources.versioned import VersionedTable

MONEY = "decimal(18,2)"


def stage_orders(orders: DataFrame) -> DataFrame:
    return orders.withColumns({"status": F.lower("status"), "channel": F.lower("channel"), "order_date": F.col("created_at").cast("date")})


def stage_customers(customers: DataFrame) -> DataFrame:
    return customers.withColumns({"email": F.lower("email"), "segment": F.lower("segment")})


def stage_products(products: DataFrame) -> DataFrame:
    return products.withColumn("category", F.lower("category"))


def stage_inventory(inventory: DataFrame) -> DataFrame:
    return inventory.withColumn("needs_reorder", F.col("quantity") <= F.col("reorder_point"))


STAGING = {"orders": stage_orders, "customers": stage_customers, "products": stage_products, "inventory": stage_inventory}


def register_staging(tables: dict[str, DataFrame]) -> None:
    """Staging is a view per table: nothing is stored."""
    for name, stage in STAGING.items():
        if name in tables:
            stage(tables[name]).createOrReplaceTempView(f"stg_{name}")


def _mean(total: str) -> Column:
    """An average of money at two digits; decimals all the way, so engines agree."""
    return F.round(F.sum(total).cast("decimal(24,6)") / F.count(total), 2).cast(MONEY)


def revenue_daily(orders: DataFrame, *, since: Column | None = None) -> DataFrame:
    """Orders (staged) by day; ``since`` keeps that day and later ones."""
    if since is not None:
        orders = orders.filter(F.col("order_date") >= since)
    cancelled = F.when(F.col("status") == "cancelled", F.col("total_amount")).otherwise(0)
    kept = F.when(F.col("status") != "cancelled", F.col("total_amount")).otherwise(0)
    return orders.groupBy(F.col("order_date").alias("revenue_date")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.sum("total_amount").cast(MONEY).alias("gross_revenue"),
        F.sum(cancelled).cast(MONEY).alias("cancelled_revenue"),
        F.sum(kept).cast(MONEY).alias("net_revenue"),
        _mean("total_amount").alias("avg_order_value"),
    )


def customer_segments(customers: DataFrame, orders: DataFrame, *, since: Column | None = None) -> DataFrame:
    """Lifetime figures per customer; ``since`` keeps customers with an order from then on, with all their orders.

    Orders are reduced to a row per customer before the join, so what is
    shuffled for it doesn't grow with a customer's orders; with ``since``, only
    the affected customers' orders are.
    """
    if since is not None:
        affected = orders.filter(F.col("created_at") >= since).select(F.col("customer_id").alias("_affected")).distinct()
        customers, orders = (df.join(affected, F.col("customer_id") == F.col("_affected"), "left_semi") for df in (customers, orders))
    totals = orders.groupBy("customer_id").agg(F.count("order_id").alias("n"), F.sum("total_amount").alias("total"), F.count("total_amount").alias("priced"), F.max("created_at").alias("last_order_at"))
    value = F.coalesce(F.round(F.col("total").cast("decimal(24,6)") / F.nullif(F.col("priced"), F.lit(0)), 2), F.lit(0))
    return customers.join(totals, "customer_id", "left").select(
        "customer_id",
        "segment",
        "region",
        F.coalesce("n", F.lit(0)).cast("long").alias("lifetime_orders"),
        F.coalesce("total", F.lit(0)).cast(MONEY).alias("lifetime_value"),
        value.cast(MONEY).alias("avg_order_value"),
        "last_order_at",
    )


def inventory_health(inventory: DataFrame, products: DataFrame) -> DataFrame:
    """Stock per product; combined by product before the join with products."""
    stock = inventory.groupBy("product_id").agg(
        F.sum("quantity").cast("long").alias("total_on_hand"),
        F.min("reorder_point").alias("reorder_point"),
        F.count_distinct("warehouse_id").alias("warehouse_count"),
        F.max(F.when(F.col("needs_reorder"), 1).otherwise(0)).alias("_low"),
    )
    health = F.when(F.col("total_on_hand") == 0, "OUT_OF_STOCK").when(F.col("_low") == 1, "REORDER").otherwise("HEALTHY")
    return stock.join(products.select("product_id", F.col("name").alias("product_name"), "category"), "product_id").select("product_id", "product_name", "category", "total_on_hand", "reorder_point", "warehouse_count", health.alias("health_status"))


RECON_DDL = "table_name string, source_rows bigint, count_match boolean, checksum_match boolean, sample_mismatches bigint, reconciliation_status string, schema_version string, reconciled_at timestamp"


def no_recon(spark: SparkSession) -> DataFrame:
    """What the summary is joined with before anything was reconciled."""
    return spark.createDataFrame([], RECON_DDL)


def migration_summary(tables: dict[str, DataFrame], recon: DataFrame, *, as_of: Column | None = None) -> DataFrame:
    """A row per table: its rows, and the last verdict on it or PENDING."""
    counts = reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("target_rows")).select(F.lit(t).alias("table_name"), "target_rows") for t, df in tables.items()])
    joined = counts.join(F.broadcast(recon), "table_name", "left")
    return joined.select(
        "table_name",
        "source_rows",
        "target_rows",
        (F.coalesce("source_rows", "target_rows") - F.col("target_rows")).alias("row_delta"),
        F.coalesce("count_match", F.lit(False)).alias("count_match"),
        "checksum_match",
        F.coalesce("sample_mismatches", F.lit(0)).cast("long").alias("sample_mismatches"),
        F.coalesce("reconciliation_status", F.lit("PENDING")).alias("reconciliation_status"),
        F.coalesce("schema_version", F.lit("v1")).alias("schema_version"),
        F.coalesce("reconciled_at", F.current_timestamp() if as_of is None else as_of).alias("last_synced_at"),
    ).orderBy("table_name")


def refresh(spark: SparkSession, path: str, mart: str, build, key: str, mark: str) -> None:
    """An incremental mart: what changed since its last ``mark`` is rebuilt and replaces its rows by ``key``.

    ``build`` takes the mark, or None for a full refresh. The mark is a scalar
    subquery in the plan that uses it, so inputs in folders by its column are
    pruned while the plan runs; in a mart without rows it is the least value
    of its type. Rows whose inputs changed before the mark are not seen; a
    full refresh is the truth.
    """
    store = VersionedTable(spark, f"{path}/{mart}")
    if not store.exists() or store.read().isEmpty():
        store.write(build(None), key=[key], buckets=4, operation="full")
        return
    upsert(spark, build(store.read().agg(F.max(mark)).scalar()), f"{path}/{mart}", [key])


def schema_name(custom: str | None, default: str) -> str:
    """Schemas are named as they are asked for, in upper case."""
    return (custom or default).strip().upper()
