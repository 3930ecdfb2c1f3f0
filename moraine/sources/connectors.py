"""Warehouse and database tables over JDBC, and lakehouse merges, where the cluster has the drivers.

Drivers of databases are not part of Spark's core, so what needs one is not tested against a server.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from moraine.sources.change_log import Log, capped, read_log
from moraine.sources.versioned import VersionedTable


def jdbc_table(spark: SparkSession, url: str, table: str, *, key: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 64, **options: str) -> DataFrame:
    """A database table with lower-case column names; with ``bounds`` of a numeric key it is read in parallel ranges."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if key and bounds:
        reader = reader.option("partitionColumn", key).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", partitions)
    df = reader.load()
    return df.toDF(*[c.lower() for c in df.columns])


def load_table(spark: SparkSession, table: str, silver_root: str, options: dict[str, str]) -> int:
    """Silver into the warehouse, replacing what is there; returns its rows.

    ``options``: with a ``path``, versioned tables under it are the warehouse;
    with a ``format``, the cluster's connector of that name, given the rest.
    """
    df = VersionedTable(spark, f"{silver_root}/{table}").read()
    rest = {k: v for k, v in options.items() if k not in ("path", "format")}
    if "format" in options:
        df.write.format(options["format"]).options(**rest, dbtable=table.upper()).mode("overwrite").save()
    else:
        VersionedTable(spark, f"{options['path']}/{table}").write(df, key=[df.columns[0]], operation="load")
    return df.count()


def read_change_log(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Raw messages of a change log from its beginning, tombstones included.

    ``limit``: about so many of them, shared by the partitions; offsets tell
    where to stop, so no more is read.
    """
    log = Log(path)
    first = log.ends(first=True)
    return read_log(spark, path, start=first, end=capped(first, log.ends(), limit))
