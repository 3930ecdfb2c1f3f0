"""Benchmark decontamination with one FM-index per shard of the training text.

A shard is a slice of a task's documents. Its words are turned into symbols of
the benchmark's vocabulary (0: any other word), its suffixes are sorted, and
the Burrows-Wheeler transform is kept in a wavelet tree. All test phrases are
then searched backwards together; the suffix positions of what was found come
from sampled positions by LF steps, and the spans are merged per document.

The benchmark is the fixed query set: it travels to the tasks in blocks of at
most ``BLOCK`` words, every block against all documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moraine.llm.common import checked, free_name, written
from moraine.llm.words import ALNUM_TABLE, slices

WINDOW = 13
#: Words of benchmark text held by a task at a time: some 60 MB of phrases.
BLOCK = 200_000
#: Bytes of document text indexed at a time.
SHARD = 4_000_000
SAMPLE = 8


@dataclass
class Phrases:
    """A block of test phrases: vocabulary, phrases by length as rows of symbols, and their items."""

    vocabulary: dict[bytes, int]
    by_length: dict[int, np.ndarray]
    items: dict[int, list[list[str | None]]]

    @property
    def shortest(self) -> int:
        return min(self.by_length)


def phrases(items: list[tuple[str | None, str]], window: int = WINDOW) -> Phrases:
    """All distinct windows of the items; an item with fewer words is one window, one without words has none."""
    vocabulary: dict[bytes, int] = {}
    owners: dict[tuple[int, ...], set[str | None]] = {}
    for item, text in items:
        symbols = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in (text or "").encode().translate(ALNUM_TABLE).split()]
        for i in range(max(1, len(symbols) - window + 1)) if symbols else ():
            owners.setdefault(tuple(symbols[i : i + window]), set()).add(item)
    by_length, names = {}, {}
    for n in sorted({len(p) for p in owners}):
        rows = sorted(p for p in owners if len(p) == n)
        by_length[n] = np.array(rows, dtype=np.int64).reshape(len(rows), n)
        names[n] = [list(owners[p]) for p in rows]
    return Phrases(vocabulary, by_length, names)


class WaveletTree:
    """Ranks of symbols in a sequence: one bit vector a level, stably partitioned by the bit above."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = max(1, int(symbols).bit_length())
        self.size = len(sequence)
        self.ones, self.zeros = [], []
        for level in reversed(range(self.levels)):
            bit = (sequence >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]))
            self.zeros.append(self.size - int(self.ones[-1][-1]))
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before position ``at``."""
        low, at = np.zeros_like(at), at.copy()
        for k, level in enumerate(reversed(range(self.levels))):
            bit = (symbol >> level) & 1
            a, b = self.ones[k][low], self.ones[k][at]
            low = np.where(bit == 1, self.zeros[k] + a, low - a)
            at = np.where(bit == 1, self.zeros[k] + b, at - b)
        return at - low

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol, at = np.zeros_like(at), at.copy()
        for k in range(self.levels):
            one = self.ones[k][at + 1] - self.ones[k][at]
            ones = self.ones[k][at]
            symbol = symbol * 2 + one
            at = np.where(one == 1, self.zeros[k] + ones, at - ones)
        return symbol


class FMIndex:
    """Of a text that ends with 0, its only 0."""

    def __init__(self, text: np.ndarray, symbols: int, sample: int = SAMPLE):
        self.n = n = len(text)
        rank, span = text.astype(np.int64), 1
        while True:  # prefix doubling, until all suffixes are told apart
            after = np.zeros(n, np.int64)
            after[:-span] = rank[span:] + 1
            key = rank * (int(rank.max()) + 2) + after
            order = np.argsort(key, kind="stable")
            steps = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
            if steps[-1] == n - 1:
                break
            rank = np.empty(n, np.int64)
            rank[order] = steps
            span *= 2
        self.tree = WaveletTree(text[order - 1], symbols)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols + 1))])
        self.sampled = np.flatnonzero(order % sample == 0)
        self.at = order[self.sampled]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of all patterns (rows of symbols), searched backwards together."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        live = np.arange(len(patterns))
        for k in reversed(range(patterns.shape[1])):
            c = patterns[live, k]
            low[live] = self.less[c] + self.tree.rank(c, low[live])
            high[live] = self.less[c] + self.tree.rank(c, high[live])
            live = live[low[live] < high[live]]
        high[low > high] = low[low > high]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: LF steps until a sampled row."""
        out, live, here, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), rows.copy(), 0
        while len(live):
            k = np.searchsorted(self.sampled, here)
            k[k == len(self.sampled)] = 0
            hit = self.sampled[k] == here
            out[live[hit]] = self.at[k[hit]] + steps
            live, here = live[~hit], here[~hit]
            if len(live):
                c = self.tree.access(here)
                here = self.less[c] + self.tree.rank(c, here)
                steps += 1
        return out


def _occurrences(index: FMIndex, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low, high = index.search(patterns)
    found = np.flatnonzero(high > low)
    counts = (high - low)[found]
    which = np.repeat(found, counts)
    rows = np.repeat(low[found], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return which, index.locate(rows)


def scan_texts(texts: list[bytes], block: Phrases) -> Iterator[tuple[int, list[tuple[int, int]], set[str | None]]]:
    """Per text: its number of words, its merged hit spans, and the items found in it."""
    get = block.vocabulary.get
    symbols, first = [], [0]
    for t in texts:
        symbols.extend([get(w, 0) for w in t.translate(ALNUM_TABLE).split()])
        first.append(len(symbols))
    first = np.array(first)
    text = np.array(symbols, dtype=np.int64)
    n = len(text)
    spans: dict[int, list[tuple[int, int]]] = {}
    items: dict[int, set[str | None]] = {}
    # Runs of benchmark words that are too short for any phrase stay out of the index, as 0s do.
    cut = np.zeros(n + 1, bool)
    cut[first] = True
    known = text > 0
    begins = known & (np.concatenate([[True], ~known[:-1]]) | cut[:-1]) if n else known
    ends = known & (np.concatenate([~known[1:], [True]]) | cut[1:]) if n else known
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    keep = end - start >= block.shortest
    start, end = start[keep], end[keep]
    if len(start):
        size = end - start + 1
        where = np.cumsum(size) - size  # each run comes after a separator 1; a 0 ends the text
        joined = np.ones(int(size.sum()) + 1, np.int64)
        origin = np.full(len(joined), -1, np.int64)
        inside = np.arange(int((size - 1).sum())) - np.repeat(np.cumsum(size - 1) - (size - 1), size - 1)
        to = np.repeat(where + 1, size - 1) + inside
        origin[to] = np.repeat(start, size - 1) + inside
        joined[to] = text[origin[to]] + 1
        joined[-1] = 0
        index = FMIndex(joined, len(block.vocabulary) + 1)
        for length, patterns in block.by_length.items():
            which, at = _occurrences(index, patterns + 1)
            places = origin[at]
            for p, s, d in zip(which.tolist(), places.tolist(), (np.searchsorted(first, places, side="right") - 1).tolist()):
                spans.setdefault(d, []).append((s - int(first[d]), s - int(first[d]) + length))
                items.setdefault(d, set()).update(block.items[length][p])
    for d in range(len(texts)):
        merged: list[list[int]] = []
        for s, e in sorted(set(spans.get(d, ()))):
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        yield int(first[d + 1] - first[d]), [(s, e) for s, e in merged], items.get(d, set())


def blocks(benchmark: DataFrame, *, block: int = BLOCK, item: str = "item_id", text: str = "text", window: int = WINDOW) -> Iterator[Phrases]:
    """The benchmark in blocks of bounded size; rows are streamed through the driver, never held whole."""
    held, size = [], 0
    for row in benchmark.select(F.col(item).cast("string"), F.col(text)).filter(F.col(text).isNotNull()).toLocalIterator():
        held.append((row[0], row[1]))
        size += len(row[1]) // 2 + 1
        if size >= block:
            yield phrases(held, window)
            held, size = [], 0
    if held:
        yield phrases(held, window)


SPANS = "row long, doc_id long, n_words long, spans array<struct<begin:int,end:int>>, items array<string>"


def removal_spans(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """Per document: its words, the merged spans of benchmark windows, and the items they come from.

    Null and wordless texts have no spans. A row with a repeated or null id
    stays a row of its own, however many blocks the benchmark has. Items with
    a null id are found like others and are one item, null, which comes first;
    items without words are never found; an empty benchmark finds nothing.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    shared = _shared(docs, benchmark, block, window)
    if len(shared) > 1:  # numbered once, so that all blocks see the same numbers
        rows = written(rows.withColumn("row", F.monotonically_increasing_id()))
    elif shared:
        rows = rows.withColumn("row", F.lit(0).cast("long"))
    return _found(rows, shared).drop("row")


def _shared(docs: DataFrame, benchmark: DataFrame, block: int, window: int) -> list:
    return [docs.sparkSession.sparkContext.broadcast(p) for p in blocks(benchmark, block=block, window=window) if p.by_length]


def _found(rows: DataFrame, blocks_: list) -> DataFrame:
    """``removal_spans`` of ``row, doc_id, text``, with ``row``; several blocks' results are merged by it."""
    found = []
    for shared in blocks_:

        def scan(batches, shared=shared):
            for batch in slices(batches, "text", SHARD):
                texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
                n, spans, items = zip(*scan_texts(texts, shared.value))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), batch.column("doc_id"), pa.array(n, pa.int64()), pa.array([[{"begin": s, "end": e} for s, e in x] for x in spans], pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))), pa.array([sorted(x, key=lambda i: (i is not None, i)) for x in items], pa.list_(pa.string()))],
                    names=["row", "doc_id", "n_words", "spans", "items"],
                )

        found.append(rows.mapInArrow(scan, SPANS))
    if not found:
        words = F.filter(F.split(F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")
        return rows.select("doc_id", F.size(words).cast("long").alias("n_words"), F.expr("cast(array() as array<struct<begin:int,end:int>>)").alias("spans"), F.expr("cast(array() as array<string>)").alias("items"))
    if len(found) == 1:
        return found[0]
    union = found[0]
    for f in found[1:]:
        union = union.unionByName(f)
    merged = union.groupBy("row", "doc_id", "n_words").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return merged.withColumn("spans", merge_spans(F.col("spans")))


def merge_spans(spans):
    """Overlapping or touching spans joined, in order."""
    return F.aggregate(
        F.array_sort(spans),
        F.expr("cast(array() as array<struct<begin:int,end:int>>)"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] >= s["begin"]),
            F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(F.try_element_at(acc, F.lit(-1))["begin"].alias("begin"), F.greatest(F.try_element_at(acc, F.lit(-1))["end"], s["end"]).alias("end")))),
        ).otherwise(F.concat(acc, F.array(s))),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every row (see ``removal_spans``). A null item counts, and has no id to join."""
    return _judged(removal_spans(docs, benchmark, **options))


def _judged(found: DataFrame, *also: str) -> DataFrame:
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["begin"]))
    return found.select(*also, "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256")).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """``docs`` without the contaminated rows, whatever their ids; all others stay as they are."""
    shared = _shared(docs, benchmark, block, window)
    if not shared:
        return docs
    number = free_name("row", docs)
    keyed = written(docs.withColumn(number, F.monotonically_increasing_id()))
    rows = keyed.select(F.col(number).alias("row"), F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    gone = written(_judged(_found(rows, shared), "row").filter("contaminated").select(F.col("row").alias(number)))
    return keyed.join(checked(gone), number, "left_anti").select(*docs.columns)
