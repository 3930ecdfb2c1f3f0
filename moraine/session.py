"""A session with the settings that the engine relies on."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """A new folder's path that the driver and all executors share, under ``spark.checkpoint.dir``.

    A local session without that setting gets one under its warehouse; on a
    cluster that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch/{spark.sparkContext.applicationId}"
    return f"{named.rstrip('/')}/{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """``df`` as files in the shared folder, for plans that would make its rows more than once."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def session(app: str = "moraine", master: str | None = None, **conf: str) -> SparkSession:
    """Adaptive execution on, UTC, ANSI left on: dirty text goes through ``try_cast``. ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
