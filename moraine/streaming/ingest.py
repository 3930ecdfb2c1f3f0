"""Change streams into versioned tables, a micro-batch at a time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from moraine.operators.cdc import MergeMetrics, apply_cdc_events
from moraine.registry import TableSpec

#: Bytes that a schema registry's wire format puts before the payload.
FRAME = 5


def envelope_schema(row: StructType) -> StructType:
    return StructType().add("op", "string").add("before", row).add("after", row).add("source", StructType().add("lsn", "long").add("ts_ms", "long")).add("ts_ms", "long")


def strip_frame(value: Column) -> Column:
    """The payload of a framed message."""
    return F.substring(value, F.lit(FRAME + 1), F.length(value) - FRAME)


def decode_json(raw: DataFrame, row: StructType, *, column: str = "value", framed: bool = False) -> DataFrame:
    """Envelopes from JSON messages. Broken messages and tombstones have no ``op`` and are dropped."""
    value = strip_frame(F.col(column)) if framed else F.col(column)
    return raw.select(F.from_json(value.cast("string"), envelope_schema(row), {"mode": "PERMISSIVE"}).alias("e")).select("e.op", "e.before", "e.after", F.col("e.source.lsn").alias("lsn"), F.coalesce("e.source.ts_ms", "e.ts_ms").alias("ts_ms")).filter("op is not null")


def decode_avro(raw: DataFrame, writer_schema: str, *, column: str = "value") -> DataFrame:
    """The same from framed Avro; needs Spark's Avro module, which is not part of the core distribution."""
    from pyspark.sql.avro.functions import from_avro

    e = raw.select(from_avro(strip_frame(F.col(column)), writer_schema, {"mode": "PERMISSIVE"}).alias("e"))
    return e.select("e.op", "e.before", "e.after", F.col("e.source.lsn").alias("lsn"), F.coalesce("e.source.ts_ms", "e.ts_ms").alias("ts_ms")).filter("op is not null")


def file_source(spark: SparkSession, path: str, row: StructType, *, max_files: int | None = None) -> DataFrame:
    """JSON envelopes from files as they arrive."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return decode_json(reader.load(path), row)


def kafka_source(spark: SparkSession, table: TableSpec, servers: str, *, starting_offsets: str = "earliest", max_offsets: int | None = None) -> DataFrame:
    """Raw messages of the table's topic; needs Spark's Kafka module, which is not part of the core distribution."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", table.topic()).option("startingOffsets", starting_offsets)
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def change_log_source(spark: SparkSession, path: str, *, starting_offsets: str = "earliest", max_offsets: int | None = None) -> DataFrame:
    """Raw messages of a change log (``sources.change_log``) as they are appended."""
    from moraine.sources.change_log import FORMAT, ChangeLog

    spark.dataSource.register(ChangeLog)
    reader = spark.readStream.format(FORMAT).option("path", path).option("startingOffsets", starting_offsets)
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def stream_table(
    spark: SparkSession,
    table: TableSpec,
    source: DataFrame,
    *,
    target_path: str,
    checkpoint_path: str,
    available_now: bool = False,
    interval: str = "10 seconds",
    guard_lsn: bool = False,
    on_batch: Callable[[int, MergeMetrics], None] | None = None,
) -> StreamingQuery:
    """Merges every micro-batch of envelopes into the table.

    Offsets are committed after the merge. If a job ends between the two, the
    batch comes again under the same number, which the table's record has for
    this stream, and nothing is done twice. A stream is known by the id in its
    checkpoint, so one with a fresh checkpoint starts its own count.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint_path
        metrics = apply_cdc_events(batch.sparkSession, batch, target_path, table, guard_lsn=guard_lsn, batch_id=batch_id, stream=stream)
        if on_batch:
            on_batch(batch_id, metrics)

    writer = source.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint_path).queryName(f"cdc_{table.name}")
    return writer.trigger(**({"availableNow": True} if available_now else {"processingTime": interval})).start()


PROGRESS_DDL = "name string, batch long, rows long, end_offsets array<string>"


class ProgressLog(StreamingQueryListener):
    """Keeps the last progress of each stream: rows, rate and how far it has read."""

    def __init__(self, keep: int = 100):
        self.keep, self.rows = keep, []

    def frame(self, spark: SparkSession) -> DataFrame:
        """What is kept, as rows for the progress page."""
        return spark.createDataFrame([(r["name"], r["batch"], r["rows"], [str(o) for o in r["end_offsets"]]) for r in self.rows], PROGRESS_DDL)

    def onQueryStarted(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.rows = [*self.rows, {"name": p.name, "batch": p.batchId, "rows": p.numInputRows, "end_offsets": [s.endOffset for s in p.sources]}][-self.keep :]

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...
