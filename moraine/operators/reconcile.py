"""Reconciliation of a source with its copy: counts, checksums, sampled rows, and a full difference."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, StructType

from moraine.functions.values import canonical, epoch_seconds, number, row_hash
from moraine.registry import TableSpec

# Which columns are compared with a tolerance, and the limits.
DECIMALS = frozenset(["unit_price", "unit_cost", "total_amount"])
TIMESTAMPS = frozenset(["created_at", "updated_at", "shipped_at", "delivered_at", "estimated_delivery"])
SAMPLE_SIZE = 1000
COUNT_DELTA = 0.01
STORED = 20
#: A sample of at most so many keys is sent to every task; a larger one is shuffled.
BROADCAST_KEYS = 1_000_000


def side_stats(df: DataFrame, columns: list[str], side: str, *, null_marker: str | None = None) -> DataFrame:
    """One row: count and order-free checksum, from one pass."""
    return df.agg(F.count(F.lit(1)).alias(f"{side}_count"), F.coalesce(F.sum(row_hash(columns, null_marker=null_marker)), F.lit(0)).cast("decimal(38,0)").cast("string").alias(f"{side}_checksum"))


def gated(stats: DataFrame) -> DataFrame:
    """Adds the verdicts on a row of both sides' stats; checksums count only where the counts are close."""
    delta = F.abs(F.col("source_count") - F.col("target_count")) / F.nullif(F.col("source_count"), F.lit(0))
    close = F.coalesce(delta, F.lit(1.0)) < COUNT_DELTA
    return stats.withColumn("count_match", F.col("source_count") == F.col("target_count")).withColumn("checksum_match", F.when(close, F.col("source_checksum") == F.col("target_checksum")))


def sample(df: DataFrame, key: str, size: int = SAMPLE_SIZE, seed: int | None = None) -> DataFrame:
    """``size`` rows: the first by a hash of the key, which ``seed`` changes. A top-k, not a sort, and the same keys each time it runs."""
    text = F.col(key).cast("string") if seed is None else F.concat(F.lit(f"{seed}/"), F.col(key).cast("string"))
    return df.orderBy(F.md5(text), F.col(key)).limit(size)


def differs(name: str, a: Column, a_type: DataType, b: Column, b_type: DataType, *, ts_tolerance: float = 1.0, dec_tolerance: float = 0.01) -> Column:
    """Whether two values of a column differ, by the column's name: instants and amounts within a tolerance, others as canonical text."""
    if name in TIMESTAMPS:
        x, y = epoch_seconds(a, a_type), epoch_seconds(b, b_type)
        far = F.abs(x - y) > ts_tolerance
    elif name in DECIMALS:
        x, y = number(a), number(b)
        far = F.abs(x - y) > F.lit(str(dec_tolerance)).cast("decimal(38,10)")
    else:
        return canonical(a, a_type) != canonical(b, b_type)
    return F.coalesce(far, x.isNull() != y.isNull())


def compare_columns(columns: list[str], source: StructType, target: StructType, **tolerances: float) -> Column:
    """Names of the columns that differ between ``s.*`` and ``t.*`` of a joined frame."""
    return F.array_compact(F.array(*[F.when(differs(c, F.col(f"s.{c}"), source[c].dataType, F.col(f"t.{c}"), target[c].dataType, **tolerances), c) for c in columns]))


def compare_row(columns: list[str], source: dict, target: dict, *, ts_tolerance: float = 1.0, dec_tolerance: float = 0.01, spark=None) -> dict[str, tuple]:
    """The same comparison for two rows given as dictionaries: each differing column with both values."""
    from pyspark.sql import SparkSession

    spark = spark or SparkSession.active()

    def frame(row: dict, alias: str) -> DataFrame:
        return spark.createDataFrame([tuple(row.get(c) for c in columns)], StructType([_field(c, row.get(c)) for c in columns])).alias(alias)

    s, t = frame(source, "s"), frame(target, "t")
    names = s.crossJoin(t).select(compare_columns(columns, s.schema, t.schema, ts_tolerance=ts_tolerance, dec_tolerance=dec_tolerance)).first()[0]  # one row with one row
    return {c: (source.get(c), target.get(c)) for c in names}


def _field(name: str, value: object):
    from datetime import datetime
    from decimal import Decimal

    from pyspark.sql.types import DecimalType, DoubleType, LongType, StringType, StructField, TimestampNTZType, TimestampType

    kinds = [(bool, BooleanType()), (int, LongType()), (float, DoubleType()), (Decimal, DecimalType(38, 10)), (datetime, TimestampType() if getattr(value, "tzinfo", None) else TimestampNTZType())]
    return StructField(name, next((k for t, k in kinds if isinstance(value, t)), StringType()))


def sample_diff(source: DataFrame, target: DataFrame, key: str, columns: list[str], *, size: int = SAMPLE_SIZE, seed: int | None = None, **tolerances: float) -> DataFrame:
    """``key, missing_in_target, fields`` of the sampled source rows that are missing or differ.

    Like the sample, this looks from the source to the target: rows that only
    the target has show in the counts, the checksum and ``full_diff``. The
    target is cut to the sample's keys where it is read, so it isn't shuffled.
    """
    picked = sample(source, key, size, seed)
    keys = picked.select(F.col(key).alias("_sampled_key"))
    keys = F.broadcast(keys) if size <= BROADCAST_KEYS else keys
    near = target.join(keys, F.col(key) == F.col("_sampled_key"), "left_semi")
    s, t = picked.alias("s"), near.withColumn("_there", F.lit(True)).alias("t")
    joined = s.join(t, F.col(f"s.{key}") == F.col(f"t.{key}"), "left")
    missing = F.col("t._there").isNull()
    fields = F.when(missing, F.expr("cast(array() as array<string>)")).otherwise(compare_columns(columns, source.schema, target.schema, **tolerances))
    return joined.select(F.col(f"s.{key}").alias(key), missing.alias("missing_in_target"), fields.alias("fields")).filter(F.col("missing_in_target") | (F.size("fields") > 0))


def full_diff(source: DataFrame, target: DataFrame, key: str, columns: list[str], **tolerances: float) -> DataFrame:
    """All keys that are on one side only, or whose rows differ."""
    s, t = source.withColumn("_here", F.lit(True)).alias("s"), target.withColumn("_there", F.lit(True)).alias("t")
    joined = s.join(t, F.col(f"s.{key}") == F.col(f"t.{key}"), "full_outer")
    kind = F.when(F.col("t._there").isNull(), "missing_in_target").when(F.col("s._here").isNull(), "extra_in_target").when(F.size("fields") > 0, "different")
    out = joined.select(F.coalesce(F.col(f"s.{key}"), F.col(f"t.{key}")).alias(key), compare_columns(columns, source.schema, target.schema, **tolerances).alias("fields"), F.col("s._here"), F.col("t._there"))
    kind = F.when(F.col("_there").isNull(), "missing_in_target").when(F.col("_here").isNull(), "extra_in_target").when(F.size("fields") > 0, "different")
    return out.withColumn("kind", kind).filter("kind is not null").select(key, "kind", F.when(F.col("kind") == "different", F.col("fields")).otherwise(F.expr("cast(array() as array<string>)")).alias("fields"))


def status(count_match: Column, checksum_match: Column, mismatches: Column) -> Column:
    return F.when(~count_match, "COUNT_MISMATCH").when(~F.coalesce(checksum_match, F.lit(True)), "CHECKSUM_MISMATCH").when(mismatches > 0, "SAMPLE_MISMATCH").otherwise("RECONCILED")


@dataclass(frozen=True)
class ReconciliationReport:
    table: str
    source_count: int
    target_count: int
    count_match: bool
    checksum_match: bool | None
    source_checksum: str
    target_checksum: str
    sample_size: int
    sample_mismatches: int
    status: str
    #: At most ``STORED`` of the differences, missing rows included.
    discrepancies: list[dict] = field(default_factory=list)


def reconciled(source: DataFrame, target: DataFrame, spec: TableSpec, *, size: int = SAMPLE_SIZE, seed: int | None = None) -> DataFrame:
    """The report as one row; ``discrepancies`` is an array of at most ``STORED`` of them."""
    columns = [c for c in spec.columns if c in source.columns and c in target.columns]
    checks = [c for c in spec.checksum if c in columns]
    diff = sample_diff(source, target, spec.primary_key, columns, size=size, seed=seed)
    first = F.row_number().over(W.orderBy(spec.primary_key))  # at most the sample's rows
    found = diff.withColumn("_n", first).agg(F.count(F.lit(1)).alias("sample_mismatches"), F.collect_list(F.when(F.col("_n") <= STORED, F.struct(F.col(spec.primary_key).cast("string").alias("key"), "missing_in_target", "fields"))).alias("discrepancies"))
    stats = [side_stats(source, checks, "source"), side_stats(target, checks, "target"), found]
    row = gated(reduce(lambda a, b: a.crossJoin(b), stats))  # one row each
    row = row.withColumn("sample_size", F.least(F.col("source_count"), F.lit(size).cast("long")))
    return row.select(F.lit(spec.name).alias("table_name"), "source_count", "target_count", "count_match", "source_checksum", "target_checksum", "checksum_match", "sample_size", "sample_mismatches", status(F.col("count_match"), F.col("checksum_match"), F.col("sample_mismatches")).alias("status"), "discrepancies")


def reconcile_table(source: DataFrame, target: DataFrame, spec: TableSpec, **options) -> ReconciliationReport:
    r = reconciled(source, target, spec, **options).first()
    return ReconciliationReport(r["table_name"], r["source_count"], r["target_count"], r["count_match"], r["checksum_match"], r["source_checksum"], r["target_checksum"], r["sample_size"], r["sample_mismatches"], r["status"], [d.asDict() for d in r["discrepancies"]])
