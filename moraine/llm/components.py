"""Connected components of an edge table, by Spark rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moraine.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id reachable) for every id in ``edges`` (``a``, ``b`` longs).

    Rounds of large-star and small-star: each links an id's neighbours to the
    smallest of them, until nothing changes. Every round is two aggregations by
    id with partial sums, so an id with very many neighbours is combined before
    it is shuffled; neighbours are never listed. The table in the shared folder
    between rounds cuts the lineage.
    """
    now = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(down.select("a", F.col("m").alias("b")))
        new = written(small.filter("a <> b").distinct())
        # Both tables have one row for an edge, so equal counts of rows and of common rows mean equal tables.
        n = new.count()
        if n == now.count() and n == new.join(now, ["a", "b"], "left_semi").count():
            break
        now = new
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)
