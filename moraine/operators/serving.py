"""Read models of the scorecard, quality, drift and catalog pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

#: Parts that the values of a group are cut into for percentiles.
PARTS = 256


def latest_run(runs: DataFrame, by: str, at: str) -> DataFrame:
    """All rows of each ``by``'s newest run, by time and not by the run's random id."""
    newest = runs.groupBy(by).agg(F.max_by("run_id", F.struct(at, "run_id")).alias("run_id"))
    return runs.join(F.broadcast(newest), [by, "run_id"], "left_semi")


def newest_per(rows: DataFrame, by: str, *order: Column) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(W.partitionBy(by).orderBy(*order))).filter("_n = 1").drop("_n")


def scorecard(summary: DataFrame) -> DataFrame:
    """One row over all tables: PENDING without any or before all are reconciled, DEGRADED after a mismatch."""
    good = F.count_if(F.col("reconciliation_status") == "RECONCILED")
    pending = F.count_if(F.col("reconciliation_status") == "PENDING")
    n = F.count(F.lit(1))
    verdict = F.when((n == 0) | (pending == n), "PENDING").when(n - good - pending > 0, "DEGRADED").when(pending > 0, "PENDING").otherwise("HEALTHY")
    return summary.agg(n.alias("tables"), good.alias("reconciled"), pending.alias("pending"), F.coalesce(F.sum("target_rows"), F.lit(0)).alias("target_rows"), F.coalesce(F.sum("row_delta"), F.lit(0)).alias("row_delta"), verdict.alias("verdict"))


def overview(summary: DataFrame) -> DataFrame:
    """The tables' rows as the page shows them, times as ISO text."""
    return summary.select("table_name", "source_rows", "target_rows", "row_delta", F.col("reconciliation_status").alias("status"), F.date_format("last_synced_at", "yyyy-MM-dd'T'HH:mm:ss").alias("last_synced_at")).orderBy("table_name")


def quality(results: DataFrame) -> DataFrame:
    """The newest run of each suite: passed, total, and whether all critical expectations hold."""
    critical = F.col("success") | (F.col("severity") != "critical")
    return latest_run(results, "suite", "validated_at").groupBy("suite", "run_id").agg(F.count_if("success").alias("passed"), F.count(F.lit(1)).alias("total"), F.bool_and(critical).alias("success")).orderBy("suite")


def quality_details(results: DataFrame, suite: str) -> DataFrame:
    """Failures first."""
    return latest_run(results.filter(F.col("suite") == suite), "suite", "validated_at").orderBy("success", "expectation")


def drift_order() -> list[Column]:
    """Gravest first, then newest."""
    rank = F.when(F.col("severity") == "BREAKING", 0).when(F.col("severity") == "AMBIGUOUS", 1).otherwise(2)
    return [rank, F.desc("detected_at"), F.col("table_name"), F.col("column_name")]


def drift_events(events: DataFrame) -> DataFrame:
    return events.orderBy(*drift_order())


def drift_by_severity(events: DataFrame) -> DataFrame:
    return events.groupBy("severity").agg(F.count(F.lit(1)).alias("events"))


def percentile(rows: DataFrame, value: str, percents: list[int], by: list[str] | None = None) -> DataFrame:
    """Nearest-rank percentiles of numbers or times: the value at place ``round(p / 100 * (n - 1))`` of each group, halves to even.

    Equal values are counted first, and all else works on those counts, so the
    rows are read once. Approximate quantiles cut each group's distinct values
    into ``PARTS`` parts, the parts' counts tell which of them hold a wanted
    place, and only those are put in order. No task sorts a whole group, and
    wherever the cuts fall, the result is exact. Other types are refused.
    """
    kind = rows.schema[value].dataType
    if not isinstance(kind, (NumericType, DateType, TimestampType, TimestampNTZType)):
        raise TypeError(f"percentiles are of numbers or times, and {value} is {kind.simpleString()}")
    by = by or []
    counts = rows.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c"))
    cuts = counts.groupBy(*by).agg(F.percentile_approx(value, [i / PARTS for i in range(1, PARTS)]).alias("_cuts"))
    cut = _beside(counts, cuts, by).withColumn("_part", F.size(F.filter("_cuts", lambda x: x <= F.col(value)))).drop("_cuts")
    parts = cut.groupBy(*by, "_part").agg(F.sum("_c").alias("_size"))
    w = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))  # PARTS rows a group
    placed = parts.withColumn("_upto", F.sum("_size").over(w.orderBy("_part"))).withColumn("_n", F.sum("_size").over(w))
    placed = placed.withColumn("percent", F.explode(F.array(*[F.lit(x) for x in percents]))).withColumn("_place", F.bround(F.col("percent") / 100.0 * (F.col("_n") - 1), 0).cast("long"))
    wanted = placed.filter("_place < _upto and _place >= _upto - _size").select(*by, "_part", "percent", (F.col("_place") - F.col("_upto") + F.col("_size")).alias("_inside"))
    inside = _beside(cut, wanted, [*by, "_part"]).withColumn("_upto", F.sum("_c").over(W.partitionBy(*by, "_part", "percent").orderBy(value)))
    return inside.filter("_inside < _upto and _inside >= _upto - _c").select(*by, F.col("percent").cast("int").alias("percent"), F.col(value).alias("value"))


def _beside(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """The inner join on ``keys``, of which nulls are equal too; without keys, ``right`` is one row."""
    right = right.select(*[F.col(c).alias(f"_right_{c}" if c in keys else c) for c in right.columns])
    same = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(right, reduce(Column.__and__, same, F.lit(True))).drop(*[f"_right_{k}" for k in keys])


def profile_of(profiles: DataFrame, table: str, column: str | None = None) -> DataFrame:
    """The stored profile of a table's columns, or of one of them."""
    rows = profiles.filter(F.col("table_name") == table)
    return (rows if column is None else rows.filter(F.col("column_name") == column)).orderBy("column_name")


def recon_statuses(summary: DataFrame) -> DataFrame:
    """Tables by their status, the last in the alphabet first, then by name."""
    return summary.select("table_name", "reconciliation_status").orderBy(F.desc("reconciliation_status"), "table_name")


def lag(rows: DataFrame, value: str) -> DataFrame:
    return rows.agg(F.count(value).alias("events"), F.min(value).alias("min_lag"), F.max(value).alias("max_lag"), F.avg(value).alias("mean_lag"))
