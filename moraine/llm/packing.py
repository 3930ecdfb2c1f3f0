"""Packed token-id rows by best-fit-decreasing.

Every document is its piece ids and an end-of-document id. The ids are those
of ``sentencepiece_lattice.encode``; a task makes them by the model's own rule
from the distinct parts of the texts at hand, in the one scan that packs them. Documents longer
than a row are cut into full rows and a rest; nothing is dropped. A task packs
the segments of a bounded piece of its documents: longest first, each into the
fullest row that still holds it, found in a segment tree over free capacities.
A packed row carries its ids as a line of a matrix, the cumulative lengths of
its segments, and positions that start again with each segment.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moraine.llm.sentencepiece_lattice import MODEL, cut, ids_of, own_rule, pieces
from moraine.llm.words import slices

LENGTH = 2048
END = 2
PAD = 0
#: Bytes of text whose segments are packed together.
PIECE = 4_000_000


class Capacities:
    """A segment tree over free capacities 0..most: how many open rows have each."""

    def __init__(self, most: int):
        self.size = 1
        while self.size <= most:
            self.size *= 2
        self.count = [0] * (2 * self.size)

    def add(self, capacity: int, n: int) -> None:
        i = self.size + capacity
        while i:
            self.count[i] += n
            i //= 2

    def smallest(self, least: int) -> int | None:
        """The smallest capacity of at least ``least`` that an open row has."""
        i = self.size + least
        if self.count[i]:
            return least
        while i > 1:
            if i % 2 == 0 and self.count[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return None


def pack(lengths: list[int], length: int = LENGTH) -> list[list[int]]:
    """Rows of segment numbers, by best-fit-decreasing; equal lengths keep their order."""
    tree, open_rows, rows = Capacities(length), {}, []
    for s in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        if not 0 < lengths[s] <= length:
            raise ValueError("a segment must have between 1 and the row's ids")
        free = tree.smallest(lengths[s])
        if free is None:
            rows.append([])
            row, free = len(rows) - 1, length
        else:
            row = open_rows[free].pop()
            tree.add(free, -1)
        rows[row].append(s)
        if free > lengths[s]:
            open_rows.setdefault(free - lengths[s], []).append(row)
            tree.add(free - lengths[s], 1)
    return rows


SCHEMA = "first_doc long, first_part int, n_tokens int, doc_ids array<long>, doc_rows array<long>, parts array<int>, cu_seqlens array<int>, ids binary, positions binary"


def _rows(docs: list[int | None], rows: list[int], ids: np.ndarray, counts: np.ndarray, length: int, end: int, pad: int) -> pa.RecordBatch:
    # All documents' ids in a row, each with its end; a segment is a range of them.
    whole = np.full(len(ids) + len(counts), end, "<u2")
    after = np.cumsum(counts + 1)
    inside = np.ones(len(whole), bool)
    inside[after - 1] = False
    whole[inside] = ids
    cuts = -(-(counts + 1) // length)
    owner = np.repeat(np.arange(len(counts)), cuts)
    part = np.arange(len(owner)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    start = (after - counts - 1)[owner] + part * length
    lengths = np.minimum(start + length, after[owner]) - start
    starts, sizes, owners, parts = start.tolist(), lengths.tolist(), owner.tolist(), part.tolist()
    out: list[list] = [[] for _ in range(9)]
    steps = np.arange(length, dtype="<u2")
    for row in pack(sizes, length):
        used = [sizes[s] for s in row]
        upto = [0, *accumulate(used)]
        line, places = np.full(length, pad, "<u2"), np.zeros(length, "<u2")
        for s, at, n in zip(row, upto, used):
            line[at : at + n] = whole[starts[s] : starts[s] + n]
            places[at : at + n] = steps[:n]
        of = [owners[s] for s in row]
        values = (docs[of[0]], parts[row[0]], upto[-1], [docs[o] for o in of], [rows[o] for o in of], [parts[s] for s in row], upto, line.tobytes(), places.tobytes())
        for column, value in zip(out, values):
            column.append(value)
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=[f.split()[0] for f in SCHEMA.split(", ")])


def packed(docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = LENGTH, end: int = END, pad: int = PAD, model: str = MODEL) -> DataFrame:
    """One row per packed line of ``length`` ids (16-bit, little-endian, padded with ``pad``; the padding's positions are 0).

    ``cu_seqlens`` has the segments' bounds, ``positions`` the place inside the
    segment, ``doc_ids`` and ``parts`` whose segments they are; ``doc_rows``
    tells rows of ``docs`` apart that share an id. Null and empty texts are one
    segment of the end id. Rows with null or repeated ids are packed like all
    others. Texts are read in one scan and not shuffled; other columns, whatever
    their names, are ignored, and an empty table gives no rows.
    """
    if not 1 <= length < 1 << 16:
        raise ValueError("positions are 16-bit")
    table = pieces(model)
    if len(table.table) > 1 << 16:
        raise ValueError("ids are 16-bit")
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        resolve = own_rule(own)
        for batch in slices(batches, "text", PIECE):
            c = cut(batch.column("text"), own)
            ids, counts = ids_of(c, own, *resolve(c.parts))
            yield _rows(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), ids, counts, length, end, pad)

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text")).mapInArrow(run, SCHEMA)


def write_packed(docs: DataFrame, path: str, **options) -> None:
    """The packed rows as Parquet: ``ids`` and ``positions`` of a file's rows are matrices of one line length."""
    packed(docs, **options).write.mode("overwrite").parquet(path)


def unpacked(rows: DataFrame) -> DataFrame:
    """``doc_id, ids`` (with the end id) again for every packed document, whatever rows its parts are in."""
    ids = F.transform(F.sequence(F.lit(0), F.col("n_tokens") - 1), lambda i: F.conv(F.concat(F.hex(F.substring("ids", i * 2 + 2, F.lit(1))), F.hex(F.substring("ids", i * 2 + 1, F.lit(1)))), 16, 10).cast("int"))
    segments = rows.select(ids.alias("ids"), "cu_seqlens", F.posexplode(F.arrays_zip("doc_ids", "doc_rows", "parts")).alias("k", "s"))
    parts = segments.select("s.doc_ids", "s.doc_rows", F.col("s.parts").alias("part"), F.slice("ids", F.get("cu_seqlens", F.col("k")) + 1, F.get("cu_seqlens", F.col("k") + 1) - F.get("cu_seqlens", F.col("k"))).alias("ids"))
    whole = parts.groupBy("doc_rows", F.col("doc_ids").alias("doc_id")).agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("part", "ids"))), lambda p: p["ids"])).alias("ids"))
    return whole.select("doc_id", "ids")
