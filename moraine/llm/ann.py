"""Nearest neighbours with a forest of random-projection trees.

The forest is fitted on the driver on a bounded sample: every inner node has a
direction through two of its sample's points and a threshold at the median
projection. All vectors are routed to one leaf of each tree. A query takes
leaves from all trees through one priority queue, by the distance to the
splits it would have to cross, and leaves and queries meet in a shuffle by
leaf, where candidates are ranked by exact distances in double precision.

Equal vectors are one candidate that knows its smallest ids, so copies cost
nothing. A leaf with many rows is dealt out in parts of bounded size, each
with all the queries that chose the leaf, again in blocks.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moraine.llm.common import written

#: Most sample vectors that the forest is fitted on.
SAMPLE = 40_000
TREES = 8
#: Sample vectors in a leaf, at most, while the sample is the whole table.
LEAF = 256
#: Leaves of a tree over more vectors than that: what a query gets back doesn't follow the table.
LEAVES = 64
#: Share of the forest's leaves, and their least number, that a query takes from the shared queue.
SHARE = 0.12
VISITS = 40
#: Rows and queries of a leaf that one task compares.
PART = 4000
QUERIES = 2000


@dataclass
class Tree:
    """Node i's direction, threshold and children; a leaf k is the child ``-k - 1``."""

    direction: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    leaves: int


def grow(sample: np.ndarray, leaf: int, rng: np.random.Generator) -> Tree:
    direction, threshold, left, right = [], [], [], []
    leaves = 0

    def build(rows: np.ndarray) -> int:
        nonlocal leaves
        if len(rows) > leaf:
            for _ in range(4):
                a, b = sample[rng.choice(rows, 2, replace=False)]
                d = a - b
                norm = np.linalg.norm(d)
                if norm == 0:
                    continue
                d = d / norm
                p = sample[rows] @ d
                cut = float(np.median(p))
                low = p < cut
                if 0 < low.sum() < len(rows):
                    node = len(direction)
                    direction.append(d)
                    threshold.append(cut)
                    left.append(0)
                    right.append(0)
                    left[node] = build(rows[low])
                    right[node] = build(rows[~low])
                    return node
        leaves += 1
        return -leaves

    build(np.arange(len(sample)))
    width = sample.shape[1] if sample.ndim == 2 else 0
    return Tree(np.array(direction, np.float64).reshape(len(direction), width), np.array(threshold), np.array(left, np.int64), np.array(right, np.int64), leaves)


def forest(sample: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = 11) -> list[Tree]:
    rng = np.random.default_rng(seed)
    return [grow(sample, leaf, rng) for _ in range(trees)]


def route(tree: Tree, vectors: np.ndarray) -> np.ndarray:
    """The leaf of each vector."""
    if not len(tree.direction):
        return np.zeros(len(vectors), np.int64)
    node = np.zeros(len(vectors), np.int64)
    live = np.arange(len(vectors))
    while len(live):
        at = node[live]
        p = np.einsum("ij,ij->i", vectors[live], tree.direction[at])
        node[live] = np.where(p < tree.threshold[at], tree.left[at], tree.right[at])
        live = live[node[live] >= 0]
    return -node - 1


def visit(trees: list[Tree], query: np.ndarray, visits: int) -> list[tuple[int, int]]:
    """(tree, leaf) pairs in the order of the shared queue: the least crossed margin first."""
    queue = [(0.0, t, 0 if len(tree.direction) else -1) for t, tree in enumerate(trees)]
    heapq.heapify(queue)
    margins = [tree.direction @ query - tree.threshold for tree in trees]
    out = []
    while queue and len(out) < visits:
        crossed, t, node = heapq.heappop(queue)
        while node >= 0:
            m = margins[t][node]
            near, far = (trees[t].left[node], trees[t].right[node]) if m < 0 else (trees[t].right[node], trees[t].left[node])
            heapq.heappush(queue, (max(crossed, abs(m)), t, int(far)))
            node = int(near)
        out.append((t, -node - 1))
    return out


def _usable(embedding: Column) -> Column:
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embedding.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(embedding, lambda x: x != 0)


def _matrix(column: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1).astype(np.float64)


def _packed(column: pa.ListArray) -> list[bytes]:
    """The components of vectors of one length as bytes, with one zero only."""
    return [v.tobytes() for v in np.asarray(column.flatten()).reshape(len(column), -1) + 0.0]


def classes(vectors: DataFrame, keep: int) -> DataFrame:
    """``vector, ids``: each distinct vector (as bytes) and its ``keep`` smallest ids, combined before the shuffle. All vectors have one length."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own: dict[bytes, list[int]] = {}
            for i, v in zip(batch.column("id").to_pylist(), _packed(batch.column("vector")) if batch.num_rows else ()):
                own.setdefault(v, []).append(i)
            yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.binary()), pa.array([sorted(set(i))[:keep] for i in own.values()], pa.list_(pa.int64()))], names=["vector", "ids"])

    few = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep)
    return vectors.mapInArrow(combine, "vector binary, ids array<long>").groupBy("vector").agg(few.alias("ids"))


GROUP = "tree int, leaf int, part int, block int, query boolean, ids array<long>, vector binary"


def _best(group: pd.DataFrame, keep: int, kind: str) -> pd.DataFrame:
    """For each query of a leaf's part, the ``keep`` nearest rows in it, by exact distance and then id.

    Products of matrices screen the rows, with a margin above their rounding;
    what passes is measured component by component.
    """
    asked, rows = group[group["query"]], group[~group["query"]]
    names = [i[0] for i in asked["ids"]]
    out: list[tuple[int, float, int]] = []
    if not len(asked) or not len(rows):
        return pd.DataFrame(out, columns=["query", "score", "vec_id"])
    q, r, ids = _matrix(asked["vector"].tolist(), kind), _matrix(rows["vector"].tolist(), kind), [list(i) for i in rows["ids"]]
    first = np.array([i[0] for i in ids])
    r2 = (r * r).sum(axis=1)
    block = max(1, 4_000_000 // len(r))
    for a in range(0, len(q), block):
        part = q[a : a + block]
        p2 = (part * part).sum(axis=1)
        rough = p2[:, None] + r2 - 2 * (part @ r.T)
        limit = np.full(len(part), np.inf)
        if len(r) > keep:
            limit = np.partition(rough, keep - 1, axis=1)[:, keep - 1] + 1e-9 * (p2 + r2.max())
        line, near = np.nonzero(rough <= limit[:, None])
        d = part[line] - r[near]
        distance = np.sqrt((d * d).sum(axis=1))
        order = np.lexsort((first[near], distance, line))
        line, near, distance = line[order], near[order], distance[order]
        cuts = np.searchsorted(line, np.arange(len(part) + 1)).tolist()
        for name, x, y in zip(names[a : a + block], cuts, cuts[1:]):
            y = min(y, x + keep)  # each class has a row at least
            found = sorted((s, i) for s, k in zip(distance[x:y].tolist(), near[x:y].tolist()) for i in ids[k])
            out += [(name, s, i) for s, i in found[:keep]]
    return pd.DataFrame(out, columns=["query", "score", "vec_id"])


def search(vectors: DataFrame, *, key: str = "vec_id", embedding: str = "embedding", every: int = 100, k: int = 10, sample: int = SAMPLE, trees: int = TREES, leaf: int = LEAF, share: float = SHARE) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest found rows, ties to the smaller id.

    Queries are the rows whose id is divisible by ``every``, candidates all
    rows but the query's own. Rows with a null id, and vectors that are null,
    empty, zero, not finite, or of another length than most, take no part.
    Rows that repeat an id and its vector are one. Without queries or other
    vectors there are no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    keep = k + 1
    # Single-precision components travel as they are; all arithmetic is in double precision.
    width, kind = ("float", "<f4") if vectors.schema[embedding].dataType.simpleString() == "array<float>" else ("double", "<f8")
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(embedding).cast(f"array<{width}>").alias("vector")).filter(F.col("id").isNotNull() & _usable(F.col("vector")))
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if sizes is None:
        return empty
    rows = rows.filter(F.size("vector") == sizes["size"])
    table = written(classes(rows, keep))
    n = table.count()
    hashed = F.pmod(F.xxhash64(F.get("ids", 0)), F.lit(1_000_000_000))
    few = table.filter(hashed < int(min(1.0, sample / n) * 1_000_000_000)).select(F.get("ids", 0).alias("id"), "vector").limit(2 * sample).collect()
    points = _matrix([bytes(r["vector"]) for r in sorted(few, key=lambda r: r["id"])], kind) if few else np.zeros((0, sizes["size"]))
    grown = forest(points, trees, max(leaf, math.ceil(1.1 * len(points) / LEAVES)))
    visits = max(VISITS, math.ceil(share * sum(t.leaves for t in grown)))
    shared = spark.sparkContext.broadcast(grown)

    # Each query's class is searched for once, however many queries it holds.
    def bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(_packed(batch.column("vector")), pa.binary())], names=["id", "vector"])

    asking = rows.filter(F.col("id") % every == 0).mapInArrow(bytes_of, "id long, vector binary").distinct()
    asking = written(asking.join(table, "vector").select("id", F.get("ids", 0).alias("query"), "vector"))
    searched = written(asking.groupBy("query").agg(F.first("vector").alias("vector")))

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector").to_pylist(), kind) if batch.num_rows else np.zeros((0, 1))
            for t, tree in enumerate(shared.value):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t, np.int32)), pa.array(route(tree, x).astype(np.int32)), batch.column("ids"), batch.column("vector")], names=["tree", "leaf", "ids", "vector"])

    def sizes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = [np.zeros(tree.leaves, np.int64) for tree in shared.value]
        for batch in batches:
            x = _matrix(batch.column("vector").to_pylist(), kind) if batch.num_rows else np.zeros((0, 1))
            for t, tree in enumerate(shared.value):
                n[t] += np.bincount(route(tree, x), minlength=tree.leaves)
        for t, count in enumerate(n):
            at = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), t, np.int32)), pa.array(at.astype(np.int32)), pa.array(count[at])], names=["tree", "leaf", "n"])

    def visited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q, v in zip(batch.column("query").to_pylist(), batch.column("vector").to_pylist()):
                at = np.array(visit(shared.value, np.frombuffer(v, kind).astype(np.float64), visits), np.int32).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(at[:, 0]), pa.array(at[:, 1]), pa.array([[q]] * len(at), pa.list_(pa.int64())), pa.array([v] * len(at), pa.binary())], names=["tree", "leaf", "ids", "vector"])

    schema = "tree int, leaf int, ids array<long>, vector binary"
    routed, wanted = table.mapInArrow(leaves, schema), written(searched.mapInArrow(visited, schema))
    # One row for each leaf of the forest, whose size the sample bounds.
    parts = table.select("vector").mapInArrow(sizes_of, "tree int, leaf int, n long").groupBy("tree", "leaf").agg(F.ceil(F.sum("n") / PART).cast("int").alias("parts"))
    blocks = wanted.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("blocks"))
    plan = written(parts.join(blocks, ["tree", "leaf"]))
    salted = lambda c: F.pmod(F.xxhash64(F.get("ids", 0)), F.col(c)).cast("int")
    each = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = routed.join(F.broadcast(plan), ["tree", "leaf"]).withColumn("part", salted("parts")).withColumn("block", each("blocks")).withColumn("query", F.lit(False))
    right = wanted.join(F.broadcast(plan), ["tree", "leaf"]).withColumn("block", salted("blocks")).withColumn("part", each("parts")).withColumn("query", F.lit(True))
    columns = [c.split()[0] for c in GROUP.split(", ")]
    best = left.select(columns).union(right.select(columns)).groupBy("tree", "leaf", "part", "block").applyInPandas(lambda g: _best(g, keep, kind), "query long, score double, vec_id long")
    # A row that several trees found is one; at most keep rows come from each leaf that the query visited.
    lists = best.groupBy("query", "vec_id").agg(F.min("score").alias("score")).groupBy("query").agg(F.slice(F.array_sort(F.collect_list(F.struct("score", "vec_id"))), 1, keep).alias("near"))
    ranked = asking.select("id", "query").join(written(lists), "query").select(F.col("id").alias("query_id"), F.posexplode(F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("id")), 1, k)).alias("rank", "x"))
    return ranked.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
