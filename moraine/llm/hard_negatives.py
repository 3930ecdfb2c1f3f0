"""Hard negatives by norm-bucketed search.

Candidates are sorted by norm and cut into buckets. By Cauchy-Schwarz no row
of a bucket scores more than the anchor's norm times the bucket's largest one,
so a bucket is skipped for every anchor whose need is higher: the running k-th
score, or the lower limit of a window. Anchors come in blocks of bounded size,
each broadcast, scored by matrix products against the bucket at hand and
dropped before the next block; vectors are shuffled once, for the sorting.
The buckets of largest norm go first, and what they find is the need that the
tasks of all other buckets start with.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from moraine.llm.common import written
from moraine.llm.words import give_back

#: Anchors of a block, about: their vectors, needs and finds are all that one broadcast and the driver hold.
ANCHORS = 3000
#: Candidates that a task scores at a time.
ROWS = 512
#: The share of the buckets (those of largest norm) that sets the first needs.
FIRST = 8
LOWEST, HIGHEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
#: Integers up to here are exact in double precision, and so are sums of products below it.
EXACT = float(1 << 53)

FOUND = "g long, id long, uid long, score long"


@dataclass
class Block:
    """Anchors: ``of`` has the rows and the matrix for each length of vector."""

    id: np.ndarray
    uid: np.ndarray
    label: np.ndarray
    norm: np.ndarray
    of: dict[int, tuple[np.ndarray, np.ndarray]]


@dataclass
class Need:
    """What each of ``j`` windows (rows) of each anchor (columns) still takes: the ``k`` best scores from ``low`` to ``high``."""

    k: int
    same: bool
    low: np.ndarray
    high: np.ndarray
    full: np.ndarray
    last: np.ndarray  # id of the k-th where full


def integers(vectors: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix of floor(256 x)) for each length of vector."""
    flat = np.asarray(vectors.flatten(), dtype=np.float64)
    ends = np.cumsum(sizes := np.asarray(vectors.value_lengths()))
    flat = np.floor(256.0 * flat)
    return [(rows := np.flatnonzero(sizes == d), flat[(ends[rows] - d)[:, None] + np.arange(d)]) for d in np.unique(sizes).tolist()]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products, exactly: in double precision where that holds them, else by Python's integers."""
    most = (np.abs(a).max() if a.size else 0.0) * (np.abs(b).max() if b.size else 0.0) * max(1, a.shape[1])
    if most < EXACT:
        return a @ b.T
    whole = np.array([[int(x) for x in row] for row in a], object) @ np.array([[int(x) for x in row] for row in b], object).T
    if any(not LOWEST < x < HIGHEST for x in whole.ravel()):
        raise OverflowError("an inner product doesn't fit a long")
    return whole.astype(np.int64)


def best(found: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` of each group ``g`` by (highest score, smallest id); columns g, id, uid, score."""
    order = np.lexsort((found[:, 2], found[:, 1], -found[:, 3], found[:, 0]))
    found = found[order]
    starts = np.flatnonzero(np.r_[True, found[1:, 0] != found[:-1, 0]]) if len(found) else np.zeros(0, int)
    rank = np.arange(len(found)) - np.repeat(starts, np.diff(np.r_[starts, len(found)]))
    return found[rank < k]


def raise_need(need: Need, found: np.ndarray) -> None:
    """Takes the k-th score of each group that has one as its need (``found`` as ``best`` gives it)."""
    n = need.low.shape[1]
    if len(found) < need.k:
        return
    kth = found[need.k - 1 :][found[need.k - 1 :, 0] == found[: len(found) - need.k + 1, 0]]
    j, a = kth[:, 0] // n, kth[:, 0] % n
    need.low[j, a], need.last[j, a], need.full[j, a] = kth[:, 3], kth[:, 1], True


def searching(block: Block, need: Need) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's work: the k best of its buckets for each window, of those that may still be wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Need(need.k, need.same, need.low.copy(), need.high, need.full.copy(), need.last.copy())
        n, found = len(block.id), np.zeros((0, 4), np.int64)
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                ids, uids, labels, norms = (np.asarray(part.column(c)) for c in ("id", "uid", "label", "norm"))
                reach = block.norm * (norms.max() * (1 + 1e-9)) + 1
                wanted = reach >= mine.low.min(axis=0)
                if not wanted.any():
                    continue
                new = [found]
                for rows, matrix in integers(part.column("v")):
                    own, vectors = block.of.get(matrix.shape[1], (np.zeros(0, int), matrix[:0]))
                    act = own[wanted[own]]
                    if not len(act):
                        continue
                    scores = products(vectors[wanted[own]], matrix)
                    allowed = (block.label[act][:, None] == labels[rows]) == need.same
                    allowed &= block.uid[act][:, None] != uids[rows]
                    for j in range(len(mine.low)):
                        low = mine.low[j, act]
                        g, c = np.nonzero(allowed & (scores >= low[:, None]) & (scores <= mine.high[j, act][:, None]))
                        score, id_ = scores[g, c].astype(np.int64), ids[rows][c]
                        keep = ~mine.full[j, act[g]] | (score > low[g]) | (id_ < mine.last[j, act[g]])
                        new.append(np.stack([j * n + act[g], id_, uids[rows][c], score], axis=1)[keep])
                if sum(map(len, new)) > len(found):
                    found = best(np.concatenate(new), need.k)
                    raise_need(mine, found)
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array(found[:, i]) for i in range(4)], names=["g", "id", "uid", "score"])

    return run


def sorted_rows(vectors: DataFrame, *, key: str, vector: str, label: str, every: int) -> DataFrame:
    """``id, label, v, norm, uid, bucket`` of all rows that take part, written by falling norm.

    A bucket is a range of (norm, id), so a vector that many rows share is cut
    like any other. Null ids stand last among ties, as the highest long.
    """
    good = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    good = good.filter(F.col("label").isNotNull() & F.col("v").isNotNull() & finite)
    scaled = F.transform("v", lambda x: F.when(F.abs(x) < float(1 << 52), F.floor(256 * x).cast("double")).otherwise(256 * x))
    good = good.select(
        F.coalesce("id", F.lit(int(HIGHEST))).alias("id"),
        F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        "v",
        F.sqrt(F.aggregate(scaled, F.lit(0.0), lambda s, x: s + x * x)).alias("norm"),
        (F.coalesce(F.col("id") % every == 0, F.lit(False))).alias("anchor"),
    )
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = good.repartitionByRange(parts, F.desc("norm"), F.asc("id")).sortWithinPartitions(F.desc("norm"))
    return written(dealt.withColumns({"uid": F.monotonically_increasing_id(), "bucket": F.spark_partition_id()}))


def block_of(anchors: DataFrame) -> Block:
    table = anchors.select("id", "uid", "label", "norm", "v").orderBy("uid").toArrow().combine_chunks()
    id_, uid, label, norm = (np.asarray(table.column(c).combine_chunks()) for c in ("id", "uid", "label", "norm"))
    vectors = table.column("v").combine_chunks()
    return Block(id_, uid, label, norm, {m.shape[1]: (rows, m) for rows, m in integers(vectors)} if len(id_) else {})


def search(rows: DataFrame, first: int, block: Block, need: Need) -> DataFrame:
    """``g, id, uid, score``: the k best of all rows for each window of the block's anchors."""
    spark = rows.sparkSession
    rank = F.row_number().over(W.partitionBy("g").orderBy(F.desc("score"), "id", "uid"))

    def shell(part: DataFrame, before: np.ndarray) -> DataFrame:
        """The k best of ``part`` and of what was found before (``k`` rows a window at most)."""
        new = part.select("id", "uid", "label", "norm", "v").mapInArrow(searching(block, need), FOUND)
        if len(before):
            new = new.union(spark.createDataFrame(pa.table([before[:, i] for i in range(4)], names=["g", "id", "uid", "score"]).to_pandas(), FOUND))
        return new.withColumn("rank", rank).filter(F.col("rank") <= need.k).drop("rank")

    head = shell(rows.filter(F.col("bucket") < first), np.zeros((0, 4), np.int64)).toArrow()
    found = best(np.stack([np.asarray(head.column(i).combine_chunks() if head.num_rows else [], np.int64) for i in range(4)], axis=1), need.k)
    raise_need(need, found)
    return shell(rows.filter(F.col("bucket") >= first), found)


def mine(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are rows whose id is divisible by ``every``; each of their best
    ``positives`` rows of the same label opens a window from ``low`` to
    ``high`` per cent of its score for rows of other labels. Rows with a null
    label, a null vector or a null or non-finite component take no part; a
    null id is no anchor, and stands last among ties. Repeated rows are rows
    of their own: only the row itself is kept from being its own partner.
    Vectors of another length than the anchor's have no product with it. A
    table without anchors gives no rows. Other columns are ignored; a score
    that no long holds is an error.
    """
    spark = vectors.sparkSession
    rows = sorted_rows(vectors, key=key, vector=vector, label=label, every=every)
    n = rows.filter("anchor").count()
    blocks = -(-n // ANCHORS)
    first = max(1, (rows.agg(F.max("bucket")).first()[0] or 0) // FIRST)
    out = []
    for b in range(blocks):
        anchors = rows.filter("anchor").filter(F.pmod(F.xxhash64("uid"), F.lit(blocks)) == b)
        block = block_of(anchors)
        if not len(block.id):
            continue
        shape = (1, len(block.id))
        want = Need(positives, True, np.full(shape, LOWEST), np.full(shape, HIGHEST), np.zeros(shape, bool), np.zeros(shape, np.int64))
        # At most ``positives`` rows for each anchor of the block.
        near = search(rows, first, block, want).toArrow()
        near = best(np.stack([np.asarray(near.column(i).combine_chunks() if near.num_rows else [], np.int64) for i in range(4)], axis=1), positives)
        starts = np.flatnonzero(np.r_[True, near[1:, 0] != near[:-1, 0]]) if len(near) else np.zeros(0, int)
        j = np.arange(len(near)) - np.repeat(starts, np.diff(np.r_[starts, len(near)]))
        shape = (positives, len(block.id))
        least, most = np.full(shape, HIGHEST), np.full(shape, LOWEST)
        least[j, near[:, 0]] = [-(-low * p // 100) for p in near[:, 3].tolist()]
        most[j, near[:, 0]] = [high * p // 100 for p in near[:, 3].tolist()]
        least[least > most] = HIGHEST
        want = Need(negatives, False, least, most, np.zeros(shape, bool), np.zeros(shape, np.int64))
        windows = pa.table([j * len(block.id) + near[:, 0], block.id[near[:, 0]], near[:, 1], near[:, 3]], names=["g", "anchor_id", "positive_id", "positive_score"]).to_pandas()
        told = spark.createDataFrame(windows, "g long, anchor_id long, positive_id long, positive_score long")
        rank = F.row_number().over(W.partitionBy("g").orderBy(F.desc("score"), "id", "uid"))
        out.append(written(search(rows, first, block, want).withColumn("rank", rank).join(F.broadcast(told), "g")))
    if not out:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    known = lambda c: F.when(F.col(c) != int(HIGHEST), F.col(c))
    return reduce(DataFrame.union, out).select("anchor_id", known("positive_id").alias("positive_id"), "rank", known("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
