"""What hangs on what: models behind a table, followed level by level, and drift explained by it."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moraine.operators.cdc import upsert
from moraine.operators.drift import DriftReport
from moraine.registry import DOWNSTREAM
from moraine.session import scratch
from moraine.sources.versioned import VersionedTable

EDGES_DDL = "parent string, child string"
#: Levels that a chain of models may have; more is a cycle, and an error.
LEVELS = 100


def model_edges(spark: SparkSession) -> DataFrame:
    """``parent, child`` of the registered tables: a table, its staging view, and the marts that read it."""
    edges = []
    for table, models in DOWNSTREAM.items():
        staged = [m for m in models if m.startswith("stg_")]
        edges += [(table, m) for m in staged] + [(s, m) for s in staged or [table] for m in models if m not in staged]
    return spark.createDataFrame(edges, EDGES_DDL)


def reach(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """``root, node, depth``: every node below each of ``roots`` (a column ``root``) with the length of its shortest path.

    Edges with a null end lead nowhere. A level is a join of the level above
    with the edges, each node once, kept in the shared folder: rows have no
    limit, and paths that meet again are followed once. Chains of more than
    ``LEVELS`` edges are taken for cycles and raise a ``ValueError``.
    """
    spark, path = edges.sparkSession, scratch(edges.sparkSession)
    edges.filter("parent is not null and child is not null").select("parent", "child").write.parquet(f"{path}/edges")
    links = spark.read.parquet(f"{path}/edges")
    last = roots.filter("root is not null").select("root", F.col("root").alias("node")).distinct()
    found = last.select("root", "node", F.lit(0).alias("depth")).limit(0)
    for depth in range(1, LEVELS + 2):
        below = last.join(links, F.col("node") == F.col("parent")).select("root", F.col("child").alias("node")).distinct()
        below.write.parquet(f"{path}/level={depth}")
        last = spark.read.parquet(f"{path}/level={depth}")
        if last.isEmpty():
            return found.groupBy("root", "node").agg(F.min("depth").alias("depth"))
        found = found.unionByName(last.select("root", "node", F.lit(depth).alias("depth")))
    raise ValueError(f"a chain has more than {LEVELS} edges: a cycle")


def downstream(spark: SparkSession, table: str, edges: DataFrame | None = None) -> list[str]:
    """Models behind a table, nearest first: a list as long as the registry's at most."""
    root = spark.createDataFrame([(table,)], "root string")
    return [r["node"] for r in reach(model_edges(spark) if edges is None else edges, root).orderBy("depth", "node").collect()]


EXPLAINED_DDL = "pattern_key string, table_name string, action string, affected string, summary string"


def explain_drift(spark: SparkSession, report: DriftReport, path: str, edges: DataFrame | None = None) -> dict[str, object]:
    """What a drift report means and reaches, kept at ``path`` under the report's pattern: the same changes are explained once.

    ``cached`` tells whether the answer was there already.
    """
    store = VersionedTable(spark, path)
    if store.exists():
        known = store.read().filter(F.col("pattern_key") == report.pattern_key).first()
        if known:
            return {**known.asDict(), "affected": json.loads(known["affected"]), "cached": True}
    affected = downstream(spark, report.table, edges) if report.changes else []
    counts: dict[str, int] = {}
    for c in report.changes:
        counts[c.severity.value] = counts.get(c.severity.value, 0) + 1
    said = ", ".join(f"{c.column}: {c.change_type.value} ({c.detail})" for c in report.changes) or "no changes"
    summary = f"{report.table}: {said}. {', '.join(f'{n} {s}' for s, n in counts.items()) or 'nothing'} to act on; behind it are {', '.join(affected) or 'no models'}."
    row = (report.pattern_key, report.table, report.recommended_action, json.dumps(affected), summary)
    upsert(spark, spark.createDataFrame([row], EXPLAINED_DDL), path, ["pattern_key"])
    return {**dict(zip([c.split()[0] for c in EXPLAINED_DDL.split(", ")], row)), "affected": affected, "cached": False}


def explain_reconciliation(history: DataFrame, table: str) -> DataFrame:
    """The newest verdict on a table with what it found, most grave first: one row, for the page that explains it."""
    newest = history.filter(F.col("table_name") == table).agg(F.max_by(F.struct("*"), F.struct("reconciled_at", "run_id")).alias("r")).filter("r is not null").select("r.*")
    delta = F.coalesce("source_count", F.lit(0)) - F.coalesce("target_count", F.lit(0))
    cause = (
        F.when(F.col("status") == "COUNT_MISMATCH", F.format_string("%s rows apart", F.abs(delta)))
        .when(F.col("status") == "CHECKSUM_MISMATCH", F.lit("as many rows, other contents"))
        .when(F.col("status") == "SAMPLE_MISMATCH", F.format_string("%s of %s sampled rows differ", "sample_mismatches", "sample_size"))
        .otherwise("equal")
    )
    return newest.select("table_name", "run_id", "status", delta.alias("row_delta"), cause.alias("cause"), "discrepancies")
