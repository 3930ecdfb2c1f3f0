"""Messages whose writers had different schemas, decoded into one row type.

A framed message names its writer's schema by number. Every schema of a batch
is one branch of one expression over one read of the messages; a branch
decodes with its own schema, and its rows are fitted to the reader's: columns
by name, missing ones null, others cast. The frame is a zero byte, the number
in four bytes, and the payload.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType, StructType

from moraine.operators.cdc import normalize
from moraine.registry import TableSpec
from moraine.streaming.ingest import decode_json, envelope_schema, stream_table, strip_frame
from moraine.streaming.newest import newest_only


def schema_id(value: Column) -> Column:
    """The number of the writer's schema; null if the message isn't framed."""
    framed = (F.length(value) > 5) & (F.hex(F.substring(value, 1, 1)) == "00")
    return F.when(framed, F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("long"))


def frame(number: int, payload: Column) -> Column:
    """``payload`` (text) as a message of that schema."""
    return F.concat(F.lit(bytes([0]) + number.to_bytes(4, "big")), payload.cast("binary"))


def load_schemas(table: DataFrame, subject: str) -> dict[int, StructType]:
    """A subject's schemas by number, from a table of ``subject, id, schema`` (JSON of a Spark schema): a few rows of metadata."""
    rows = table.filter(F.col("subject") == subject).select(F.col("id").cast("long").alias("id"), "schema").collect()
    return {r["id"]: StructType.fromJson(json.loads(r["schema"])) for r in rows}


def save_schema(spark: SparkSession, path: str, subject: str, number: int, schema: StructType) -> None:
    """Adds a schema to the table at ``path``; the same number again is refused, since messages rely on it."""
    from moraine.operators.cdc import upsert
    from moraine.sources.versioned import VersionedTable

    store = VersionedTable(spark, path)
    if store.exists() and not store.read().filter((F.col("subject") == subject) & (F.col("id") == number)).isEmpty():
        raise ValueError(f"{subject} has a schema {number} already")
    upsert(spark, spark.createDataFrame([(subject, number, schema.json())], "subject string, id long, schema string"), path, ["subject", "id"])


def fitted(value: Column, there: DataType, wanted: DataType) -> Column:
    """``value`` as ``wanted``: fields by name, missing ones null, values that don't cast null."""
    if isinstance(there, StructType) and isinstance(wanted, StructType):
        fields = {f.name: f for f in there}
        parts = [(fitted(value[f.name], fields[f.name].dataType, f.dataType) if f.name in fields else F.lit(None).cast(f.dataType)).alias(f.name) for f in wanted]
        return F.when(value.isNotNull(), F.struct(*parts))
    return value if there == wanted else value.try_cast(wanted)


def decode_versions(raw: DataFrame, schemas: Mapping[int, StructType | str], row: StructType, *, column: str = "value", avro: bool = False) -> DataFrame:
    """``op, before, after, lsn, ts_ms`` of framed envelopes, whatever schema each was written with.

    ``schemas``: the writers' row schemas by number, for Avro their envelope
    schemas as JSON text. Tombstones, broken messages and messages of unknown
    schemas have no ``op`` and are dropped; ``unreadable`` finds them.
    """
    return _opened(raw, schemas, row, column, avro).filter("e.op is not null").select("e.op", "e.before", "e.after", "e.lsn", "e.ts_ms")


def unreadable(raw: DataFrame, schemas: Mapping[int, StructType | str], row: StructType, *, column: str = "value", avro: bool = False) -> DataFrame:
    """The messages that ``decode_versions`` drops, tombstones aside, with the number of their schema."""
    return _opened(raw, schemas, row, column, avro).filter(F.col(column).isNotNull() & F.col("e.op").isNull()).drop("e")


def _opened(raw: DataFrame, schemas: Mapping[int, StructType | str], row: StructType, column: str, avro: bool) -> DataFrame:
    wanted = StructType().add("op", "string").add("before", row).add("after", row).add("lsn", "long").add("ts_ms", "long")
    payload, decoded = strip_frame(F.col(column)), F.lit(None).cast(wanted)
    for number, schema in schemas.items():
        if avro:
            from pyspark.sql.avro.functions import from_avro  # a module of its own

            one = from_avro(payload, schema, {"mode": "PERMISSIVE"})
            there = raw.select(one.alias("e")).schema["e"].dataType
        else:
            there = envelope_schema(schema)
            one = F.from_json(payload.cast("string"), there, {"mode": "PERMISSIVE"})
        flat = F.struct(
            one["op"].alias("op"),
            fitted(one["before"], there["before"].dataType, row).alias("before"),
            fitted(one["after"], there["after"].dataType, row).alias("after"),
            one["source"]["lsn"].alias("lsn"),
            F.coalesce(one["source"]["ts_ms"], one["ts_ms"]).alias("ts_ms"),
        )
        decoded = F.when(F.col("schema_id") == number, flat).otherwise(decoded)
    return raw.withColumn("schema_id", schema_id(F.col(column))).withColumn("e", decoded)


def stream_messages(
    spark: SparkSession,
    table: TableSpec,
    raw: DataFrame,
    *,
    target_path: str,
    checkpoint_path: str,
    schemas: Mapping[int, StructType | str] | None = None,
    avro: bool = False,
    drop_stale: bool = False,
    ttl_ms: int | None = None,
    **options,
) -> StreamingQuery:
    """A table's raw messages, from a topic or a change log, into its versioned table: decode, drop stale events, merge.

    ``schemas``: the writers' schemas of framed messages by number; without
    them a message is bare JSON. ``drop_stale`` keeps the highest log position
    of each key in the stream's state (for ``ttl_ms``, or for good). ``options``
    are ``stream_table``'s. For a topic of Avro messages: ``raw`` from
    ``kafka_source``, the schemas' texts, and ``avro=True``.
    """
    events = decode_versions(raw, schemas, table.schema, avro=avro) if schemas else decode_json(raw, table.schema)
    if drop_stale:
        events = newest_only(normalize(events, table.columns), table.primary_key, ttl_ms=ttl_ms)
    return stream_table(spark, table, events, target_path=target_path, checkpoint_path=checkpoint_path, **options)
