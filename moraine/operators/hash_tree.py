"""Differences of two tables by trees of hashes: equal branches are never opened.

A row's place follows from the hash of its key, four bits a level; a node's
hash is the sum of its rows' hashes. A side's tree is stored once, with its
rows in folders by their first levels and in order of their leaves. Two
trees are compared from the top: a level's nodes are looked at only under
parents that differ, and rows are read only from folders, and kept only from
leaves, that differ. What the leaves hold is then compared column by column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from moraine.functions.values import canonical
from moraine.operators.reconcile import full_diff

#: Bits a level, and levels that make a folder of rows: 256 folders, or 16 where a tree has two levels only.
BITS, FOLDER = 4, 2
#: Rows that a leaf has about, which sets the depth.
LEAF_ROWS = 1_000
#: At most so many leaves are sent to every task; more are shuffled.
BROADCAST_LEAVES = 1_000_000
#: The node of rows with a null key. A null is equal to nothing, so it always differs.
NULLS = -1
NODES = "node long, n long, h decimal(38,0)"


def levels_for(rows: int) -> int:
    """Levels that make leaves of about ``LEAF_ROWS`` rows."""
    levels = FOLDER
    while levels < 12 and (1 << (BITS * levels)) * LEAF_ROWS < rows:
        levels += 1
    return levels


def _below_folders(levels: int) -> int:
    """Bits of a leaf's number below its folder's."""
    return BITS * (levels - (FOLDER if levels > FOLDER else FOLDER - 1))


@dataclass(frozen=True)
class HashTree:
    """The stored tree of one side at ``path``."""

    spark: SparkSession
    path: str
    key: str
    levels: int
    schema: StructType

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/rows")

    def nodes(self, level: int) -> DataFrame:
        """``node, n, h`` of a level, which has 16 to its power at most, and one for null keys."""
        return self.spark.read.schema(NODES).parquet(f"{self.path}/level={level}")


def write_tree(df: DataFrame, path: str, key: str, columns: list[str], *, levels: int) -> HashTree:
    """Stores ``df``'s rows and nodes. Both sides of a comparison need the same ``columns`` and ``levels``.

    Values are hashed as canonical text, so the sides may spell types
    differently. One shuffle, by folder; nodes are summed from the stored rows.
    """
    if not FOLDER <= levels <= 15:
        raise ValueError(f"a tree has {FOLDER} to 15 levels")
    taken = {"_leaf", "_folder"} & set(df.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are the tree's own")
    spark, kinds = df.sparkSession, {f.name: f.dataType for f in df.schema}
    # Separators can't be made by shifting text between columns, as each is hashed with its length.
    texts = [canonical(F.col(c), kinds[c]) for c in sorted(columns)]
    row = F.xxhash64(*[x for t in texts for x in (F.length(t), t)])
    leaf = F.when(F.col(key).isNull(), F.lit(NULLS).cast("long")).otherwise(F.shiftrightunsigned(F.xxhash64(canonical(F.col(key), kinds[key])), 64 - BITS * levels))
    folder = F.when(leaf < 0, NULLS).otherwise(F.shiftright(leaf, _below_folders(levels))).cast("int")
    # Null keys may be many, and need no order: they are dealt out. What follows from a row is made anew behind the shuffle and where rows are read, not moved or stored.
    dealt = df.repartition(folder, F.when(folder < 0, F.pmod(row, F.lit(64)))).withColumns({"_leaf": leaf, "_folder": folder}).sortWithinPartitions("_folder", "_leaf")
    dealt.write.partitionBy("_folder").mode("overwrite").parquet(f"{path}/rows")
    tree = HashTree(spark, path, key, levels, dealt.schema)
    leaves = tree.rows().groupBy(F.col("_leaf").alias("node")).agg(F.count(F.lit(1)).alias("n"), F.sum(row.cast("decimal(28,0)")).cast("decimal(38,0)").alias("h"))
    leaves.write.mode("overwrite").parquet(f"{path}/level={levels}")
    for level in range(levels - 1, 0, -1):
        up = tree.nodes(level + 1).groupBy(F.when(F.col("node") < 0, F.col("node")).otherwise(F.shiftright("node", BITS)).alias("node"))
        up.agg(F.sum("n").alias("n"), F.sum("h").cast("decimal(38,0)").alias("h")).write.mode("overwrite").parquet(f"{path}/level={level}")
    return tree


def unequal(source: HashTree, target: HashTree, level: int, parents: DataFrame | None) -> DataFrame:
    """``node`` of a level that differ, of those under ``parents``."""

    def side(tree: HashTree, name: str) -> DataFrame:
        nodes = tree.nodes(level)
        if parents is not None:
            up = F.when(F.col("node") < 0, F.col("node")).otherwise(F.shiftright("node", BITS))
            nodes = nodes.join(parents.select(F.col("node").alias("_parent")), up == F.col("_parent"), "left_semi")
        return nodes.select("node", F.col("n").alias(f"{name}_n"), F.col("h").alias(f"{name}_h"))

    both = side(source, "s").join(side(target, "t"), "node", "full_outer")
    same = F.col("s_n").eqNullSafe(F.col("t_n")) & F.col("s_h").eqNullSafe(F.col("t_h")) & (F.col("node") != NULLS)
    return both.filter(~same).select("node")


def tree_diff(source: HashTree, target: HashTree, columns: list[str], scratch: str, **tolerances: float) -> DataFrame:
    """``key, kind, fields`` as ``full_diff`` gives them for the rows of both trees.

    Each level's unequal nodes are a table under ``scratch``, which the next
    level starts from; where none is left nothing more is read.
    """
    if (source.levels, source.key) != (target.levels, target.key):
        raise ValueError("the trees differ in key or depth")
    spark, left, n = source.spark, None, 0
    for level in range(1, source.levels + 1):
        unequal(source, target, level, left).write.mode("overwrite").parquet(f"{scratch}/unequal={level}")
        left = spark.read.parquet(f"{scratch}/unequal={level}")
        n = left.count()
        if not n:
            break
    if not n:
        return full_diff(source.rows().limit(0).drop("_folder"), target.rows().limit(0).drop("_folder"), source.key, columns, **tolerances)
    folder = F.when(F.col("node") < 0, F.col("node")).otherwise(F.shiftright("node", _below_folders(source.levels)))
    folders = [r[0] for r in left.select(folder.cast("int").alias("f")).distinct().collect()]  # at most 257
    leaves = left.select(F.col("node").alias("_node"))
    leaves = F.broadcast(leaves) if n <= BROADCAST_LEAVES else leaves

    def opened(tree: HashTree) -> DataFrame:
        return tree.rows().filter(F.col("_folder").isin(folders)).join(leaves, F.col("_leaf") == F.col("_node"), "left_semi").drop("_folder", "_leaf")

    return full_diff(opened(source), opened(target), source.key, columns, **tolerances)


def diff_by_tree(source: DataFrame, target: DataFrame, key: str, columns: list[str], scratch: str, **tolerances: float) -> DataFrame:
    """Stores both trees under ``scratch`` and compares them."""
    levels = levels_for(source.count())
    trees = [write_tree(df, f"{scratch}/{side}", key, columns, levels=levels) for df, side in ((source, "source"), (target, "target"))]
    return tree_diff(*trees, columns, scratch, **tolerances)
