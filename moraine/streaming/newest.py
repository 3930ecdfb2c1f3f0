"""Stale events dropped in the stream itself, by state that is kept for each key."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The state store that keyed state with a time-to-live needs.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Newest(StatefulProcessor):
    """Keeps the highest log position of its key; of a batch's events the newest goes on, if it is newer than that.

    Events of one position are one event, whichever comes first. Events
    without a position go on as they are and leave no mark.
    """

    def __init__(self, columns: list[str], ttl_ms: int | None):
        self.columns, self.ttl_ms = columns, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.top, self.row = handle.getValueState("top", "lsn long", self.ttl_ms), Row(*self.columns)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        seen = self.top.get()
        top, best = (seen[0] if seen else None), None
        for r in rows:  # one row is kept, however many events the key has
            if r["lsn"] is None:
                yield self.row(*[r[c] for c in self.columns])
            elif top is None or r["lsn"] > top:
                top, best = r["lsn"], r
        if best is not None:
            self.top.update((top,))
            yield self.row(*[best[c] for c in self.columns])

    def close(self) -> None: ...


def newest_only(events: DataFrame, key: str, *, ttl_ms: int | None = None) -> DataFrame:
    """Streamed flat events (``cdc.normalize``) without those that aren't newer than all that came before under their key.

    The state is a number for each key. With ``ttl_ms`` it goes when a key has
    been quiet for so long; an event that is later than that is taken as new,
    so the merge behind it keeps its own guard. Null keys are dropped, as the
    merge does.
    """
    spark: SparkSession = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    keyed = events.filter(F.col(key).isNotNull())
    mode = "ProcessingTime" if ttl_ms else "None"
    return keyed.groupBy(key).transformWithState(Newest(events.columns, ttl_ms), events.schema, "Append", mode)
