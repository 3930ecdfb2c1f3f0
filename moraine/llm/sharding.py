"""Sharding by a hierarchical weighted hash tree.

A row descends region -> rack -> shard. At every level each child draws
``-ln(u) / weight`` with ``u`` hashed from the row's key and the child's name,
and the smallest draw wins. A child's draw depends on nothing but itself, so a
changed weight moves rows only into or out of that child's subtree.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Shard:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def grid(shards: int, *, base: int = 16, per_rack: int = 4, racks: int = 2) -> list[Shard]:
    """``base`` shards in racks of ``per_rack`` and regions of ``racks`` racks; each further shard opens a region.

    A new shard in a region of its own takes rows from all others and gives
    none of its rows or theirs to an older shard.
    """
    tree = []
    for s in range(shards):
        if s < base:
            tree.append(Shard(s // (per_rack * racks), s // per_rack % racks, s))
        else:
            tree.append(Shard(1_000_000 + s, 0, s))
    return tree


def _draw(key: Column, level: str, *name: int, weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(level), *[F.lit(n) for n in name]), 11)
    return -F.log((bits.cast("double") + 0.5) / float(1 << 53)) / F.lit(float(weight))


def _winner(draws: list[tuple[Column, int]]) -> Column:
    if len(draws) == 1:
        return F.lit(draws[0][1])
    return F.array_min(F.array(*[F.struct(d.alias("draw"), F.lit(n).alias("child")) for d, n in draws]))["child"]


def descend(key: Column, tree: list[Shard]) -> Column:
    """The shard of ``key`` in ``tree``, as one expression without a shuffle."""
    if not tree or any(s.weight <= 0 for s in tree):
        raise ValueError("a tree needs shards, all of positive weight")
    regions: dict[int, dict[int, list[Shard]]] = {}
    for s in tree:
        regions.setdefault(s.region, {}).setdefault(s.rack, []).append(s)

    def weight(shards: list[Shard]) -> float:
        return sum(s.weight for s in shards)

    def rack_choice(region: int) -> Column:
        racks = regions[region]
        choice = _winner([(_draw(key, "rack", region, r, weight=weight(ss)), r) for r, ss in racks.items()])
        leaf = None
        for r, ss in racks.items():
            one = _winner([(_draw(key, "shard", s.shard, weight=s.weight), s.shard) for s in ss])
            leaf = F.when(choice == r, one) if leaf is None else leaf.when(choice == r, one)
        return leaf

    region = _winner([(_draw(key, "region", g, weight=sum(map(weight, racks.values()))), g) for g, racks in regions.items()])
    out = None
    for g in regions:
        out = F.when(region == g, rack_choice(g)) if out is None else out.when(region == g, rack_choice(g))
    return out.cast("int")


def assign(docs: DataFrame, *, shards: int = 16, key: str = "doc_id", text: str = "text", tree: list[Shard] | None = None, grown: list[Shard] | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row.

    ``slot`` numbers the rows of a shard from 0 without gaps: rows are numbered
    inside (shard, bucket) groups of bounded size, and a table of one row per
    group gives each group's offset. Null texts have size 1 and the CRC of the
    empty text; rows with a null or repeated id all go where that id goes and
    get slots of their own. An empty table gives no rows; other columns of
    ``docs`` are ignored.
    """
    spark = docs.sparkSession
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tree, grown = tree or grid(shards), grown or grid(shards + 1)
    keyed = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    placed = keyed.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).cast("long").alias("text_crc32"),
        descend(F.col("doc_id"), tree).alias("shard"),
        F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int").alias("bucket"),
        descend(F.col("doc_id"), grown).alias("grown_shard"),
    )
    counts = (
        keyed.select(descend(F.col("doc_id"), tree).alias("shard"), F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int").alias("bucket"))
        .groupBy("shard", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # At most shards x buckets rows, whatever the input.
    offsets = counts.withColumn("offset", F.sum("n").over(W.partitionBy("shard").orderBy("bucket")) - F.col("n")).drop("n")
    inside = F.row_number().over(W.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size"))
    return (
        placed.withColumn("inside", inside)
        .join(F.broadcast(offsets), ["shard", "bucket"])
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("offset") + F.col("inside") - 1).cast("long").alias("slot"), "grown_shard")
    )
