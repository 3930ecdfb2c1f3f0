"""What several operators need from the session."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir.

    Where none is named, a local session gets one of its own under its
    warehouse; on a cluster that is an error, as executors need a shared one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    own = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints/{spark.sparkContext.applicationId}"
    spark.conf.set("spark.checkpoint.dir", own)
    return own


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting that holds for what runs inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


#: Bytes of a batch that goes to Python, rows of a batch that is read, and bytes of a row group that is written.
LEAN = {"spark.sql.execution.arrow.maxBytesPerBatch": "3000000b", "spark.sql.parquet.columnarReaderBatchSize": "512", "parquet.block.size": "8000000"}


def lean(spark: SparkSession) -> None:
    """Batches of whole texts in small portions from here on, so that a task's memory doesn't follow its split; what the session has set itself stays.

    Spark's own limits are 64 MB, 4,096 rows and 128 MB. What is asked for here is run later, so the settings stay, too.
    """
    for key, value in LEAN.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and its lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/t-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores until no frame has such a column."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Most rows of ids (16 bytes each, or fewer) that are sent whole to every task; more of them are shuffled.
BROADCAST_ROWS = 1_000_000


def checked(ids: DataFrame, rows: int | None = None) -> DataFrame:
    """``ids`` (a written table of a few narrow columns) with a broadcast hint if its counted rows allow it."""
    from pyspark.sql import functions as F

    return F.broadcast(ids) if (ids.count() if rows is None else rows) <= BROADCAST_ROWS else ids
