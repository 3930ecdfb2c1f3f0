"""Ingest, promotion, Gold and backfill as plain functions with gates between them."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moraine.operators import cdc, drift, expectations, gold, reconcile, silver
from moraine.registry import TABLES, TableSpec
from moraine.sources.change_log import Log
from moraine.sources.versioned import VersionedTable
from moraine.streaming.ingest import change_log_source, decode_json, stream_table
from moraine.streaming.lag import OffsetLedger, committed, lag

#: Events behind the log's head that make ingest a bulk load.
LAG_LIMIT = 10_000


class GateFailed(Exception):
    """A stage found something that must not go further."""


@dataclass
class Paths:
    """Where a migration keeps its tables."""

    root: str

    def of(self, layer: str, table: str = "") -> str:
        return f"{self.root}/{layer}" + (f"/{table}" if table else "")


@dataclass
class Run:
    steps: list[tuple[str, object]] = field(default_factory=list)

    def note(self, step: str, outcome: object) -> None:
        self.steps.append((step, outcome))


def retried(work: Callable[[], object], attempts: int = 3, wait: float = 1.0) -> object:
    """Tries again after ``wait`` seconds, then after twice as long each time."""
    for k in range(attempts):
        try:
            return work()
        except cdc.SchemaMismatchError:
            raise  # trying again doesn't change a schema
        except Exception:
            if k + 1 == attempts:
                raise
            time.sleep(wait * 2**k)


def ingest(spark: SparkSession, paths: Paths, batches: dict[str, DataFrame], *, guard_lsn: bool = True) -> Run:
    """Merges a batch of events per table and refuses to leave an empty table behind."""
    run = Run()
    for name, events in batches.items():
        waiting = events.count()
        run.note(f"{name}: lag", "bulk" if waiting > LAG_LIMIT else "normal")
        run.note(f"{name}: merge", retried(lambda e=events, n=name: cdc.apply_cdc_events(spark, e, paths.of("bronze", n), TABLES[n], guard_lsn=guard_lsn)))
        store = VersionedTable(spark, paths.of("bronze", name))
        if not store.exists() or store.read().isEmpty():
            raise GateFailed(f"bronze {name} is empty")
    return run


def ingest_log(spark: SparkSession, paths: Paths, logs: dict[str, str], *, capped: int = LAG_LIMIT) -> Run:
    """Brings each table up to the head of its change log, as far as it goes now.

    How much waits is told by offsets before anything is read: up to
    ``LAG_LIMIT`` messages are taken in one batch of at most ``capped``, more
    of them as a bulk run without a cap. What the stream commits goes to the
    ledger that the next run's lag is measured from.
    """
    run, ledger, kept = Run(), OffsetLedger(), paths.of("meta", "ingest_offsets")
    for name, log in logs.items():
        stream = f"cdc_{name}"
        waiting = sum(lag(log, committed(spark, kept, stream)).values())
        bulk = waiting > LAG_LIMIT
        run.note(f"{name}: lag", {"messages": waiting, "mode": "bulk" if bulk else "normal"})
        done: list[cdc.MergeMetrics] = []

        def merge(n: str = name, path: str = log, most: int | None = None if bulk else capped, out: list = done) -> None:
            source = decode_json(change_log_source(spark, path, max_offsets=most), TABLES[n].schema)
            query = stream_table(spark, TABLES[n], source, target_path=paths.of("bronze", n), checkpoint_path=paths.of("meta", f"checkpoints/{n}"), available_now=True, guard_lsn=True, on_batch=lambda _, m: out.append(m))
            query.awaitTermination()
            for p in query.recentProgress:
                ledger.note(f"cdc_{n}", 0, p.sources[0].endOffset)

        if waiting:
            retried(merge)
            ledger.store(spark, kept)
        run.note(f"{name}: merge", done)
        if not VersionedTable(spark, paths.of("bronze", name)).exists():
            raise GateFailed(f"bronze {name} is empty")
    return run


def promote(spark: SparkSession, paths: Paths, tables: list[str], *, suites: list[str] | None = None, as_of: Column | None = None, baseline: str | None = None) -> Run:
    """Bronze to Silver, then the drift gate, then the suites; breaking drift or a failed suite stops the run."""
    run = Run()
    for name in tables:
        bronze = VersionedTable(spark, paths.of("bronze", name)).read()
        if baseline:
            report = drift.detect_drift(bronze, name, baseline)
            run.note(f"{name}: drift", report.recommended_action)
            if report.changes:
                drift.report_frame(spark, report).write.mode("append").parquet(paths.of("meta", "drift_events"))
            if report.has_breaking:
                raise GateFailed(f"breaking drift of {name}: {[c.column for c in report.changes]}")
        run.note(f"{name}: promote", silver.bronze_to_silver(spark, name, paths.of("bronze", name), paths.of("silver", name), paths.of("quarantine", name), as_of=as_of))
    for suite in suites or ():
        result = expectations.run_suite(spark, suite, paths.of("silver"), results_path=paths.of("meta", "validation_results"))
        run.note(suite, result.success)
        if not result.success:
            raise GateFailed(f"{suite}: {[r.expectation for r in result.results if not r.success]}")
    return run


def build_gold(spark: SparkSession, paths: Paths, *, full: bool = False) -> Run:
    """All marts from Silver; incremental ones continue from where they are. Marts that fail their suite stop the run."""
    run, read = Run(), lambda t: VersionedTable(spark, paths.of("silver", t)).read()
    orders, customers = gold.stage_orders(read("orders")), gold.stage_customers(read("customers"))
    if full:
        VersionedTable(spark, paths.of("gold", "gold_revenue_daily")).write(gold.revenue_daily(orders), key=["revenue_date"], buckets=4, operation="full")
        VersionedTable(spark, paths.of("gold", "gold_customer_segments")).write(gold.customer_segments(customers, orders), key=["customer_id"], buckets=4, operation="full")
    else:
        gold.refresh(spark, paths.of("gold"), "gold_revenue_daily", lambda m: gold.revenue_daily(orders, since=m), "revenue_date", "revenue_date")
        gold.refresh(spark, paths.of("gold"), "gold_customer_segments", lambda m: gold.customer_segments(customers, orders, since=m), "customer_id", "last_order_at")
    if VersionedTable(spark, paths.of("silver", "inventory")).exists():
        health = gold.inventory_health(gold.stage_inventory(read("inventory")), gold.stage_products(read("products")))
        VersionedTable(spark, paths.of("gold", "gold_inventory_health")).write(health, key=["product_id"], buckets=4, operation="full")
    run.note("gold", "built")
    result = expectations.run_suite(spark, "gold_suite", paths.of("gold"), results_path=paths.of("meta", "validation_results"))
    run.note("gold_suite", result.success)
    if not result.success:
        raise GateFailed(f"gold_suite: {[r.expectation for r in result.results if not r.success]}")
    return run


def reconcile_all(spark: SparkSession, paths: Paths, sources: dict[str, DataFrame], layer: str = "silver") -> DataFrame:
    """Reconciles each source with its table, stores the verdicts (one current row a table, and the history), and returns the summary."""
    rows = None
    for name, source in sources.items():
        r = reconcile.reconciled(source, VersionedTable(spark, paths.of(layer, name)).read(), TABLES[name])
        rows = r if rows is None else rows.unionByName(r)
    run_id = uuid.uuid4().hex[:12]
    now = rows.withColumns({"run_id": F.lit(run_id), "reconciled_at": F.current_timestamp()})
    # A folder a run: what was just computed is read back without the history before it.
    written = paths.of("meta", f"reconciliation_history/run={run_id}")
    now.withColumn("discrepancies", F.to_json("discrepancies")).write.parquet(written)
    recon = spark.read.parquet(written).select("table_name", F.col("source_count").alias("source_rows"), "count_match", "checksum_match", "sample_mismatches", F.col("status").alias("reconciliation_status"), F.lit("v1").alias("schema_version"), "reconciled_at")
    cdc.upsert(spark, recon, paths.of("meta", "migration_metadata"), ["table_name"], buckets=1)
    return gold.migration_summary({t: VersionedTable(spark, paths.of(layer, t)).read() for t in sources}, VersionedTable(spark, paths.of("meta", "migration_metadata")).read())


def backfill(spark: SparkSession, events: DataFrame, path: str, table: TableSpec, *, column: str, start, end, reset: bool = False) -> cdc.MergeMetrics:
    """Replays the events whose ``column`` lies in ``[start, end)``; ``reset`` empties the table first."""
    part = events.filter((F.col(column) >= start) & (F.col(column) < end))
    store = VersionedTable(spark, path)
    if reset and store.exists():
        store.write(store.read(hidden=True).limit(0), key=[table.primary_key], buckets=store.commit().bucket_count, operation="reset")
    return cdc.apply_cdc_events(spark, part, path, table, guard_lsn=not reset)
