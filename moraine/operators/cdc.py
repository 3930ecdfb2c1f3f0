"""Change events: normalised, reduced to one per key, and merged into a table."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from moraine.registry import TableSpec
from moraine.sources.versioned import BUCKET, VersionedTable, bucket_of

META = ("op", "lsn", "ts_ms")
#: Bytes of files that a bucket should have at most: what a merge reads and rewrites for one key.
BUCKET_BYTES = 256 << 20


class SchemaMismatchError(Exception):
    def __init__(self, table: str, added: set[str], dropped: set[str]):
        super().__init__(f"{table}: columns added {sorted(added)}, dropped {sorted(dropped)}")
        self.table, self.added, self.dropped = table, added, dropped


@dataclass(frozen=True)
class MergeMetrics:
    table: str
    input_events: int = 0
    inserted: int = 0
    updated: int = 0
    deleted: int = 0
    skipped: int = 0


def event_columns(events: DataFrame) -> set[str]:
    """The business columns that events carry, flat or in an envelope."""
    names = set(events.columns)
    if {"before", "after"} <= names:
        return {f for side in ("before", "after") for f in events.schema[side].dataType.names}
    return names - set(META)


def check_columns(events: DataFrame, expected: list[str], table: str) -> None:
    there = event_columns(events)
    if there != set(expected):
        raise SchemaMismatchError(table, there - set(expected), set(expected) - there)


def normalize(events: DataFrame, columns: list[str]) -> DataFrame:
    """``columns, op, lsn, ts_ms``: the row before a delete, the row after anything else. Flat events pass through."""
    names = events.columns
    ts = F.coalesce(F.col("ts_ms").cast("long"), F.lit(0).cast("long")) if "ts_ms" in names else F.lit(0).cast("long")
    lsn = F.col("source.lsn") if "source" in names and "lsn" not in names else F.col("lsn")
    if {"before", "after"} <= set(names):
        row = [F.when(F.col("op") == "d", F.col(f"before.{c}")).otherwise(F.col(f"after.{c}")).alias(c) for c in columns]
    else:
        row = [F.col(c) for c in columns]
    return events.filter("op is not null").select(*row, "op", lsn.cast("long").alias("lsn"), ts.alias("ts_ms"))


def latest(events: DataFrame, key: str) -> DataFrame:
    """The newest event of each key by ``lsn``, then ``ts_ms``; the rest of the row breaks ties, so the result is always the same."""
    ties = [F.desc_nulls_last(c) for c in ("lsn", "ts_ms", "op", *[c for c in events.columns if c not in (*META, key)])]
    return events.filter(F.col(key).isNotNull()).withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy(*ties))).filter("_n = 1").drop("_n")


def merged(target: DataFrame, changes: DataFrame, key: str, *, guard_lsn: bool = False) -> DataFrame:
    """The full outer join behind a merge: new rows with ``_action`` (insert, update, delete, keep, or null for no-ops).

    Which side a row is on is told by marker columns, never by null values.
    With ``guard_lsn`` the target has ``_lsn`` and ``_deleted``: an event that
    isn't newer than what its key has seen is ignored, and deletes leave a
    tombstone.
    """
    columns = [c for c in target.columns if c not in ("_lsn", "_deleted", key)]
    t = target.select(F.col(key).alias("_tk"), *[F.col(c).alias(f"_t_{c}") for c in target.columns if c != key], F.lit(True).alias("_t"))
    s = changes.select(F.col(key).alias("_sk"), *[F.col(c).alias(f"_s_{c}") for c in columns], F.col("op").alias("_op"), F.col("lsn").alias("_s_lsn"), F.lit(True).alias("_s"))
    both = t.join(s, F.col("_tk") == F.col("_sk"), "full_outer")
    there, came = F.coalesce("_t", F.lit(False)), F.coalesce("_s", F.lit(False))
    if guard_lsn:
        came = came & (~there | F.col("_t__lsn").isNull() | F.coalesce(F.col("_s_lsn") > F.col("_t__lsn"), F.lit(False)))
        there_live = there & ~F.coalesce("_t__deleted", F.lit(False))
    else:
        there_live = there
    gone = F.col("_op") == "d"
    action = F.when(came & there_live & gone, "delete").when(came & there_live, "update").when(came & ~gone, "insert").when(came, F.lit(None)).when(there, "keep")
    out = [F.coalesce("_tk", "_sk").alias(key), *[F.when(came, F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")).alias(c) for c in columns]]
    if guard_lsn:
        out += [F.when(came, F.col("_s_lsn")).otherwise(F.col("_t__lsn")).alias("_lsn"), F.when(came, gone).otherwise(F.coalesce("_t__deleted", F.lit(False))).alias("_deleted")]
    return both.select(*out, action.alias("_action"), came.alias("_came"))


def survivors(frame: DataFrame, *, guard_lsn: bool = False) -> DataFrame:
    """What of ``merged`` is stored."""
    stays = F.col("_action").isin("insert", "update", "keep")
    return frame.filter(stays | F.col("_came") | F.col("_action").isNotNull() if guard_lsn else stays).drop("_action", "_came")


def apply_cdc_events(
    spark: SparkSession,
    events: DataFrame,
    target_path: str,
    table: TableSpec,
    *,
    allow_schema_evolution: bool = False,
    guard_lsn: bool = False,
    buckets: int = 16,
    batch_id: int | None = None,
    stream: str = "",
) -> MergeMetrics:
    """Merges a batch into the versioned table at ``target_path``; only the buckets its keys fall into are read and rewritten.

    An empty batch changes nothing. A ``batch_id`` that this ``stream`` has
    already got to is a replay and changes nothing, whatever was written
    between; another stream counts its own batches. With
    ``allow_schema_evolution`` new columns join the table as nullable ones;
    dropped or retyped columns are refused. A table whose buckets have grown
    over ``BUCKET_BYTES`` is dealt to more of them (``split_buckets``).
    """
    if events.isEmpty():
        return MergeMetrics(table.name)
    store = VersionedTable(spark, target_path)
    last = store.commit() if store.exists() else None
    done = last.applied.get(stream) if last else None
    if done is not None and batch_id is not None and batch_id <= done["batch"]:
        return MergeMetrics(table.name, **(done["metrics"] if batch_id == done["batch"] else {}))
    batch = None if batch_id is None else (stream, batch_id)
    known = [c for c in StructType.fromJson(last.schema).names if not c.startswith("_")] if last else table.business_columns
    if not allow_schema_evolution:
        if last is not None or event_columns(events) != set(table.business_columns):
            check_columns(events, known, table.name)
        columns = known
    else:
        there = event_columns(events)
        if set(known) - there:
            raise SchemaMismatchError(table.name, there - set(known), set(known) - there)
        columns = known + sorted(there - set(known))
    rows = normalize(events, columns)
    changes = latest(rows, table.primary_key).persist()
    try:
        counted = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(table.primary_key).isNotNull().cast("int")).alias("keyed")).first()
        if changes.isEmpty():
            return MergeMetrics(table.name, counted["n"], skipped=counted["n"])
        count = last.bucket_count if last else buckets
        touched = sorted(r[0] for r in changes.select(bucket_of([table.primary_key], count).alias("b")).distinct().collect())  # at most ``count`` numbers
        if last:
            target = store.read(buckets=touched, hidden=True)
        else:
            target = spark.createDataFrame([], changes.drop(*META).schema)
        for c in columns:
            if c not in target.columns:
                target = target.withColumn(c, F.lit(None).cast(changes.schema[c].dataType))
            elif target.schema[c].dataType != changes.schema[c].dataType:
                raise SchemaMismatchError(table.name, {c}, {c})
        if guard_lsn and "_lsn" not in target.columns:
            target = target.withColumn("_lsn", F.lit(None).cast("long")).withColumn("_deleted", F.lit(False))
        seen = Observation()
        frame = merged(target, changes, table.primary_key, guard_lsn=guard_lsn)
        counts = [F.count(F.when(F.col("_action") == a, 1)).alias(n) for a, n in (("insert", "inserted"), ("update", "updated"), ("delete", "deleted"))]
        plain, frame = frame, frame.observe(seen, *counts)
        out = survivors(frame, guard_lsn=guard_lsn).withColumn(BUCKET, bucket_of([table.primary_key], count))

        def metrics() -> dict[str, int]:
            try:
                got = dict(seen.get)
            except Py4JJavaError:  # nothing was observed where nothing was left to write
                got = plain.agg(*counts).first().asDict()
            return {"input_events": counted["n"], **got, "skipped": max(counted["n"] - sum(got.values()), 0)}

        if last:
            commit = store.write(out, key=[table.primary_key], buckets=touched, operation="merge", replace=False, batch=batch, metrics_of=metrics)
            split_buckets(spark, target_path)
        else:
            commit = store.write(out, key=[table.primary_key], buckets=count, operation="merge", batch=batch, metrics_of=metrics)
        return MergeMetrics(table.name, **commit.metrics)
    finally:
        changes.unpersist()


def bucket_bytes(spark: SparkSession, path: str) -> dict[int, int]:
    """Bytes of each bucket's files in the last version, by listing."""
    commit, out = VersionedTable(spark, path).commit(), {}
    for b, v in commit.buckets.items():
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/data/v={v}/{BUCKET}={b}")
        out[int(b)] = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    return out


def split_buckets(spark: SparkSession, path: str, *, limit: int | None = None) -> int:
    """Deals a table to twice (or four times, ...) as many buckets if the mean of its buckets is over ``limit`` bytes; returns their number.

    One rewrite of the whole table each time it has doubled, so over a
    table's life every row is moved once or twice for it.
    """
    store = VersionedTable(spark, path)
    commit, sizes = store.commit(), bucket_bytes(spark, path)
    count, total = commit.bucket_count, sum(sizes.values())
    while total > count * (BUCKET_BYTES if limit is None else limit):
        count *= 2
    if count > commit.bucket_count:
        store.write(store.read(hidden=True), key=commit.key, buckets=count, operation="split")
    return count


def upsert(spark: SparkSession, rows: DataFrame, path: str, key: list[str], *, buckets: int = 4) -> None:
    """Rows replace those with the same composite key; the rest stays. Used for metadata and incremental marts.

    Only the buckets that the rows' keys fall into are read and rewritten. The
    rows are cast to the stored types, so that equal keys share a bucket. Two
    rows of one key (nulls are equal) are refused: neither is the newer one.
    """
    store = VersionedTable(spark, path)
    if not store.exists():
        rows = rows.persist()
        try:
            _refuse_repeated(rows, key, path)
            store.write(rows, key=key, buckets=buckets, operation="upsert")
        finally:
            rows.unpersist()
        return
    last, stored = store.commit(), store.read().schema
    if last.key != key:
        raise ValueError(f"{path} is keyed by {last.key}, not by {key}")
    if set(rows.columns) != set(stored.names):
        raise SchemaMismatchError(path, set(rows.columns) - set(stored.names), set(stored.names) - set(rows.columns))
    rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in stored]).persist()
    try:
        _refuse_repeated(rows, key, path)
        touched = sorted(r[0] for r in rows.select(bucket_of(key, last.bucket_count).alias("b")).distinct().collect())  # at most as many numbers as buckets
        if touched:
            old = store.read(buckets=touched)
            same = reduce(Column.__and__, [old[k].eqNullSafe(rows[k]) for k in key])
            new = old.join(rows, same, "left_anti").unionByName(rows).withColumn(BUCKET, bucket_of(key, last.bucket_count))
            store.write(new, key=key, buckets=touched, operation="upsert", replace=False)
    finally:
        rows.unpersist()


def _refuse_repeated(rows: DataFrame, key: list[str], path: str) -> None:
    several = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").first()
    if several:
        raise ValueError(f"{several['_n']} rows for {path} have the key {[several[k] for k in key]}")
