"""A versioned Parquet table: hash buckets of rows, and a commit record for each version.

A version rewrites only the buckets it touches; its record says which version
each bucket's files are from. A record is written aside and then renamed, so a
version exists whole or not at all, and a reader that has resolved a version
is not disturbed by a later one. One writer at a time is assumed.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKET = "_bucket"


@dataclass
class Commit:
    version: int
    schema: dict
    #: Bucket number as text -> version of its files.
    buckets: dict[str, int] = field(default_factory=dict)
    bucket_count: int = 1
    key: list[str] = field(default_factory=list)
    operation: str = "write"
    metrics: dict[str, int] = field(default_factory=dict)
    #: Stream -> its last batch in this table and that batch's metrics; handed on from version to version.
    applied: dict[str, dict] = field(default_factory=dict)


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # Records are small files; Hadoop's file system reaches whatever store the data is in.
    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _versions(self) -> list[int]:
        fs, p = self._fs(f"{self.path}/_commits")
        if not fs.exists(p):
            return []
        found = [(s.getPath().getName(), s.getLen()) for s in fs.listStatus(p)]
        # Empty records are what older writers left when they were lost halfway.
        return sorted(int(n[:-5]) for n, size in found if n.endswith(".json") and n[:-5].isdigit() and size)

    def exists(self) -> bool:
        return bool(self._versions())

    def commit(self, version: int | None = None) -> Commit:
        """The record of a version, by default the last."""
        versions = self._versions()
        if not versions:
            raise FileNotFoundError(f"no table at {self.path}")
        text = "".join(r[0] for r in self.spark.read.text(f"{self.path}/_commits/{versions[-1] if version is None else version:09d}.json", wholetext=True).collect())
        return Commit(**json.loads(text))

    def history(self) -> list[Commit]:
        return [self.commit(v) for v in self._versions()]

    def _record(self, commit: Commit) -> None:
        fs, p = self._fs(f"{self.path}/_commits/{commit.version:09d}.json")
        _, aside = self._fs(f"{self.path}/_commits/_{commit.version:09d}-{uuid.uuid4().hex}")
        out = fs.create(aside, False)
        out.write(bytearray(json.dumps(commit.__dict__, sort_keys=True).encode()))
        out.close()
        if fs.exists(p) and fs.getFileStatus(p).getLen() == 0:
            fs.delete(p, False)
        if fs.exists(p) or not fs.rename(aside, p):  # local file systems would rename over a record
            fs.delete(aside, False)
            raise FileExistsError(f"{self.path} has a version {commit.version} already")

    def read(self, version: int | None = None, buckets: list[int] | None = None, hidden: bool = False) -> DataFrame:
        """A version's rows; ``buckets`` reads some of its buckets only, ``hidden`` keeps deleted rows and their marks."""
        c = self.commit(version)
        schema = StructType.fromJson(c.schema)
        wanted = [b for b in c.buckets if buckets is None or int(b) in buckets]
        paths = [f"{self.path}/data/v={c.buckets[b]}/{BUCKET}={b}" for b in wanted]
        df = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        if not hidden and "_deleted" in df.columns:
            df = df.filter(~F.col("_deleted")).drop("_deleted", "_lsn")
        return df

    def write(self, df: DataFrame, *, key: list[str], buckets: int = 16, operation: str = "overwrite", replace: bool = True, batch: tuple[str, int] | None = None, metrics: dict[str, int] | None = None, metrics_of=None) -> Commit:
        """A new version. ``replace``: of all rows and the schema; else only of the buckets that ``df`` (which has ``_bucket``) was made for, ``buckets`` a list of them.

        ``metrics_of``: called after the files are written, for counts observed while they were.
        """
        versions = self._versions()
        last = self.commit() if versions else None
        version = versions[-1] + 1 if versions else 0
        touched = list(range(buckets)) if replace else buckets
        count = buckets if replace else last.bucket_count
        if BUCKET not in df.columns:
            df = df.withColumn(BUCKET, bucket_of(key, count))
        schema = df.drop(BUCKET).schema
        # Rebalancing evens out large buckets and keeps small ones in one file.
        df.hint("rebalance", BUCKET).write.partitionBy(BUCKET).mode("overwrite").parquet(f"{self.path}/data/v={version}")
        fs, p = self._fs(f"{self.path}/data/v={version}")
        there = {s.getPath().getName().split("=")[1] for s in fs.listStatus(p) if s.getPath().getName().startswith(BUCKET)}
        kept = {} if replace else {b: v for b, v in last.buckets.items() if int(b) not in touched}
        counts = metrics or (metrics_of() if metrics_of else {})
        applied = (last.applied if last else {}) | ({batch[0]: {"batch": batch[1], "metrics": counts}} if batch else {})
        commit = Commit(version, schema.jsonValue(), kept | {b: version for b in there}, count, key, operation, counts, applied)
        self._record(commit)
        return commit


def bucket_of(key: list[str], count: int):
    return F.pmod(F.xxhash64(*[F.col(k) for k in key]), F.lit(count)).cast("int")
