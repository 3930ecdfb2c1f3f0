"""A partitioned change log as a Spark data source, for batch and streaming reads and for appends.

Messages of one key share a partition, where each has an offset; readers keep
their own place. A partition is a folder of Parquet segments named by the
offsets they hold, ``p=00003/<first>-<end>.parquet``, so that a listing tells
how far the log goes without reading any of it. Files are reached through
Arrow's file systems: a local or mounted path, or a URI that Arrow knows.
One writer at a time is assumed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "change_log"
SCHEMA = "partition int, offset bigint, timestamp timestamp, key binary, value binary"
_ARROW = pa.schema([("partition", pa.int32()), ("offset", pa.int64()), ("timestamp", pa.timestamp("us", "UTC")), ("key", pa.binary()), ("value", pa.binary())])
_STORED = pa.schema([f for f in _ARROW if f.name not in ("partition", "offset")])
#: Rows that a reader hands over at a time, and that a segment has at most.
ROWS, SEGMENT = 10_000, 1_000_000

Offsets = dict[str, int]


@dataclass
class Piece(InputPartition):
    """Offsets ``start`` to ``end`` (exclusive) of one segment."""

    partition: int
    file: str
    first: int
    start: int
    end: int


@dataclass
class Wrote(WriterCommitMessage):
    """(partition, temporary file, rows) in the order of the messages."""

    files: list[tuple[int, str, int]]


class Log:
    """The log's segments, by listing."""

    def __init__(self, path: str):
        self.fs, self.root = pyarrow.fs.FileSystem.from_uri(path)

    def segments(self) -> dict[int, list[tuple[int, int, str]]]:
        out: dict[int, list[tuple[int, int, str]]] = {}
        found = self.fs.get_file_info(pyarrow.fs.FileSelector(self.root, allow_not_found=True, recursive=True))
        for f in found:
            folder, _, name = f.path.rpartition("/")
            folder = folder.rpartition("/")[2]
            if f.type == pyarrow.fs.FileType.File and folder.startswith("p=") and name.endswith(".parquet"):
                first, _, end = name[:-8].partition("-")
                out.setdefault(int(folder[2:]), []).append((int(first), int(end), f.path))
        return {p: sorted(s) for p, s in sorted(out.items())}

    def ends(self, *, first: bool = False) -> Offsets:
        """Each partition's next offset, or its first one."""
        return {str(p): s[0][0] if first else s[-1][1] for p, s in self.segments().items()}

    def pieces(self, start: Offsets, end: Offsets) -> list[Piece]:
        """Segments and parts of segments from ``start`` (a partition that isn't in it: from its beginning) to ``end``."""
        out = []
        for p, segments in self.segments().items():
            low, high = start.get(str(p), 0), end.get(str(p), 0)
            out += [Piece(p, file, a, max(a, low), min(b, high)) for a, b, file in segments if max(a, low) < min(b, high)]
        return out

    def read(self, piece: Piece) -> Iterator[pa.RecordBatch]:
        at = piece.first
        with self.fs.open_input_file(piece.file) as f:
            for batch in pq.ParquetFile(f).iter_batches(ROWS):
                a, b = max(piece.start - at, 0), min(piece.end - at, batch.num_rows)
                if a < b:
                    part = batch.slice(a, b - a)
                    own = [pa.array([piece.partition] * (b - a), pa.int32()), pa.array(range(at + a, at + b), pa.int64())]
                    yield pa.RecordBatch.from_arrays([*own, *(part.column(n).cast(_ARROW.field(n).type) for n in _STORED.names)], schema=_ARROW)
                at += batch.num_rows
                if at >= piece.end:
                    return


def bounds(log: Log, said: str) -> Offsets:
    """``earliest``, ``latest``, or offsets by partition as JSON."""
    if said in ("earliest", "latest"):
        return log.ends(first=said == "earliest")
    return {str(p): int(o) for p, o in sorted(json.loads(said).items(), key=lambda x: int(x[0]))}


def capped(at: Offsets, head: Offsets, most: int | None) -> Offsets:
    """How far a batch goes from ``at``: all the way, or ``most`` messages, shared by how many wait in each partition."""
    waiting = {p: max(0, h - at.get(p, 0)) for p, h in head.items()}
    total = sum(waiting.values())
    if most is None or total <= most:
        return {p: max(h, at.get(p, 0)) for p, h in head.items()}
    return {p: at.get(p, 0) + min(n, -(-n * most // total)) for p, n in waiting.items()}


class BatchReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.start, self.end = options["path"], options.get("startingOffsets", "earliest"), options.get("endingOffsets", "latest")

    def partitions(self) -> list[Piece]:
        log = Log(self.path)
        return log.pieces(bounds(log, self.start), bounds(log, self.end)) or [Piece(0, "", 0, 0, 0)]

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        if partition.file:
            yield from Log(self.path).read(partition)


class StreamReader(DataSourceStreamReader):
    """Offsets are ``{partition: next offset}``. A batch ends where the engine has asked for it, so a restart reads the same one again."""

    def __init__(self, options: dict[str, str]):
        self.path, self.start = options["path"], options.get("startingOffsets", "earliest")
        self.most = int(options["maxOffsetsPerTrigger"]) if options.get("maxOffsetsPerTrigger") else None
        self.at: Offsets | None = None

    def initialOffset(self) -> Offsets:
        log = Log(self.path)
        # Partitions that a given place leaves out are read from their beginning, as those that are made later.
        return log.ends(first=True) | bounds(log, self.start)

    def latestOffset(self) -> Offsets:
        at = self.initialOffset() if self.at is None else self.at
        return dict(sorted((at | capped(at, Log(self.path).ends(), self.most)).items(), key=lambda x: int(x[0])))

    def partitions(self, start: Offsets, end: Offsets) -> list[Piece]:
        self.at = end  # also what a restarted query has seen
        return Log(self.path).pieces(start, end)

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        return Log(self.path).read(partition)

    def commit(self, end: Offsets) -> None: ...


class Writer(DataSourceArrowWriter):
    """Tasks write segments aside; the driver gives them their offsets by naming them, in the order of the tasks."""

    def __init__(self, path: str):
        self.path, self.aside = path, f"_incoming/{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Wrote:
        log, files = Log(self.path), []
        folder = f"{log.root}/{self.aside}"
        log.fs.create_dir(folder, recursive=True)
        out = None
        try:
            for batch in iterator:
                partitions = batch.column(batch.schema.get_field_index("partition"))
                rows = pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(n)).cast(_STORED.field(n).type) for n in _STORED.names], schema=_STORED)
                numbers = np.asarray(partitions)
                cuts = (np.flatnonzero(np.diff(numbers)) + 1).tolist()
                for a, b in zip([0, *cuts], [*cuts, batch.num_rows]) if batch.num_rows else ():  # runs of one partition: rows come sorted
                    p = int(numbers[a])
                    if out is None or files[-1][0] != p or files[-1][2] >= SEGMENT:
                        if out is not None:
                            out.close()
                        files.append((p, f"{folder}/{uuid.uuid4().hex}.parquet", 0))
                        out = pq.ParquetWriter(files[-1][1], _STORED, filesystem=log.fs)
                    out.write_batch(rows.slice(a, b - a))
                    files[-1] = (*files[-1][:2], files[-1][2] + b - a)
        finally:
            if out is not None:
                out.close()
        return Wrote(files)

    def commit(self, messages: list[Wrote | None]) -> None:
        log = Log(self.path)
        head = {int(p): o for p, o in log.ends().items()}
        for p, file, rows in (f for m in messages if m for f in m.files):
            a = head.get(p, 0)
            log.fs.create_dir(f"{log.root}/p={p:05d}", recursive=True)
            log.fs.move(file, f"{log.root}/p={p:05d}/{a:020d}-{a + rows:020d}.parquet")
            head[p] = a + rows
        self.abort(messages)

    def abort(self, messages: list[Wrote | None]) -> None:
        log = Log(self.path)
        if log.fs.get_file_info(f"{log.root}/{self.aside}").type == pyarrow.fs.FileType.Directory:
            log.fs.delete_dir(f"{log.root}/{self.aside}")


class ChangeLog(DataSource):
    """Options: ``path``; ``startingOffsets``, ``endingOffsets`` (batch); ``maxOffsetsPerTrigger`` (stream)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> BatchReader:
        return BatchReader(self.options)

    def streamReader(self, schema: StructType) -> StreamReader:
        return StreamReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        if overwrite:
            raise ValueError("a change log is only appended to")
        return Writer(self.options["path"])


def read_log(spark: SparkSession, path: str, *, start: str | Offsets = "earliest", end: str | Offsets = "latest") -> DataFrame:
    """The log's messages between two places, a task for each segment."""
    spark.dataSource.register(ChangeLog)
    said = lambda x: x if isinstance(x, str) else json.dumps(x)
    return spark.read.format(FORMAT).option("path", path).option("startingOffsets", said(start)).option("endingOffsets", said(end)).load()


def append_log(messages: DataFrame, path: str, *, key: str, value: str, order: str, partitions: int = 8) -> None:
    """Appends ``value`` (text or bytes, null for a tombstone) under ``key``, in the order of ``order`` inside each partition.

    A key's partition follows from the key alone, so its messages stay in
    order over all appends with the same number of ``partitions``; null keys
    share one. A partition is written by one task, row by row.
    """
    messages.sparkSession.dataSource.register(ChangeLog)
    rows = messages.select(
        F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(partitions)).cast("int").alias("partition"),
        F.col(order).alias("_order"),
        F.current_timestamp().alias("timestamp"),
        F.col(key).cast("string").cast("binary").alias("key"),
        F.col(value).cast("binary").alias("value"),
    )
    dealt = rows.repartition(partitions, "partition").sortWithinPartitions("partition", "_order")
    dealt.select("partition", F.lit(None).cast("long").alias("offset"), "timestamp", "key", "value").write.format(FORMAT).option("path", path).mode("append").save()
