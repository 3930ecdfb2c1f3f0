"""How far readers are behind a change log, from offsets alone: nothing of the log is read."""

from __future__ import annotations

import ast
import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from moraine.operators.cdc import upsert
from moraine.sources.change_log import Log, Offsets
from moraine.sources.versioned import VersionedTable

LEDGER_DDL = "stream string, source int, partition int, committed long"


def _read(text: str) -> object:
    """JSON, or what Python makes of JSON: progress events have either."""
    for read in (json.loads, ast.literal_eval):
        try:
            return read(text)
        except (ValueError, SyntaxError):
            continue
    return None


class OffsetLedger(StreamingQueryListener):
    """What each stream has committed, from its progress events: an event comes after its batch is done.

    ``store`` writes what was heard since, a row for each stream, source and
    partition, and ``committed`` reads a stream's rows back.
    """

    def __init__(self) -> None:
        self.heard: dict[tuple[str, int, int], int] = {}
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        p = event.progress
        for k, s in enumerate(p.sources):
            self.note(p.name or p.id, k, s.endOffset)

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    def note(self, stream: str, source: int, end: str | dict | None) -> None:
        """Takes an end offset if it is a map from partitions to places; other sources have none."""
        offsets = _read(end) if isinstance(end, str) else end
        if isinstance(offsets, dict) and all(str(p).isdigit() and isinstance(o, int) for p, o in offsets.items()):
            with self.lock:
                self.heard |= {(str(stream), source, int(p)): o for p, o in offsets.items()}

    def store(self, spark: SparkSession, path: str) -> None:
        with self.lock:
            rows = [(*k, o) for k, o in self.heard.items()]
            self.heard = {}
        if rows:
            upsert(spark, spark.createDataFrame(rows, LEDGER_DDL), path, ["stream", "source", "partition"])


def committed(spark: SparkSession, path: str, stream: str, source: int = 0) -> Offsets:
    """A stream's stored offsets, as many as its source has partitions; none before its first batch."""
    store = VersionedTable(spark, path)
    if not store.exists():
        return {}
    rows = store.read().filter((F.col("stream") == stream) & (F.col("source") == source)).collect()
    return {str(r["partition"]): r["committed"] for r in rows}


def lag(log_path: str, done: Offsets) -> Offsets:
    """Messages that wait in each partition. A partition without a commit waits from its first offset on."""
    log = Log(log_path)
    firsts = log.ends(first=True)
    return {p: max(0, head - done.get(p, firsts[p])) for p, head in log.ends().items()}


def lag_frame(spark: SparkSession, log_path: str, ledger_path: str, stream: str) -> DataFrame:
    """``partition, head, committed, lag`` of a stream, for the ingest page."""
    done = committed(spark, ledger_path, stream)
    waiting = lag(log_path, done)
    rows = [(int(p), head, done.get(p), waiting[p]) for p, head in Log(log_path).ends().items()]
    return spark.createDataFrame(rows, "partition int, head long, committed long, lag long")
