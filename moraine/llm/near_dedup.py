"""Near duplicates by b-bit MinHash, with links confirmed on full shingle sets.

1. One scan makes each document's sketch: the number of its distinct word
   shingles, a 128-bit digest of the set, the minima of ``BANDS * ROWS`` hash
   functions folded into bands, and their low ``BITS`` bits packed into longs.
2. Equal sets become one class, represented by its smallest id.
3. Representatives that share a band are candidates. Only their shingles are
   looked at again. A shingle that no other candidate has can't be shared by a
   link, which bounds every similarity from above and, by the smallest set in
   a bucket, tells most members of large buckets that they have no link there.
4. In each bucket all remaining members are paired with its most central one
   (fewest shingles of its own). Pairs pass the bounds, then the b-bit estimate
   with a margin of six standard deviations, then the exact test. What is
   linked is one component. Members of one bucket that are still in different
   components are paired under the same tests and one more: how many of their
   rarest shingles they share bounds how many they can share at all.
5. Components are found by rounds of large-star and small-star.

With 32 bands of 5 rows a pair of similarity 0.85 (0.8) meets in no bucket
with a chance of 7e-9 (3e-6). Nothing is capped or sampled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from moraine.llm.common import checked, free_name, written
from moraine.llm.components import components
from moraine.llm.words import Words, grams, mix, slices, words

SHINGLE = 5
BANDS = 32
ROWS = 5
BITS = 4
#: Shingles of a member that pairs are bounded by before their sets are compared.
HEAD = 64
#: Bytes of text whose sketches a task makes at a time; their memory is some 40 times that.
PIECE = 1_000_000
_PER_LONG = 64 // BITS
_LONGS = -(-BANDS * ROWS // _PER_LONG)
_ONES = int("1" * (64 // BITS), 2**BITS) if BITS < 4 else 0x1111111111111111


def shingles(w: Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all documents, in one array, and where each document's begin (one more entry at the end).

    A document with fewer than ``k`` words, but some, has one shingle: all its words.
    """
    whole = grams(w.hash, k)
    out, first = [], [0]
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if b - a >= k:
            own = np.unique(whole[a : b - k + 1])
        elif b > a:
            own = mix(grams(w.hash[a:b], b - a) + np.uint64(b - a))
        else:
            own = whole[:0]
        out.append(own)
        first.append(first[-1] + len(own))
    return (np.concatenate(out) if out else whole[:0]), np.array(first)


def minima(sets: np.ndarray, first: np.ndarray, functions: int) -> np.ndarray:
    """``functions`` minima of each set (at least one element each), as rows."""
    rows = len(first) - 1
    out = np.empty((rows, functions), np.uint64)
    if rows:
        for i in range(functions):
            out[:, i] = np.minimum.reduceat(sets * (mix(np.uint64([2 * i + 1])) | np.uint64(1)) ^ mix(np.uint64([2 * i + 2])), first[:-1])
    return out


SKETCH = "doc_id long, text_hash long, n_shingles long, digest_a long, digest_b long, bands array<long>, signature array<long>"


def _sketch(batch: pa.RecordBatch, k: int) -> pa.RecordBatch:
    w = words(batch.column("text"), lower=True)
    sets, first = shingles(w, k)
    count = np.diff(first)
    full = np.flatnonzero(count)
    at = np.append(first[:-1][full], len(sets))
    low = minima(sets, at, BANDS * ROWS)
    band = np.zeros((len(full), BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(len(full), b + 1, np.uint64)
        for r in range(ROWS):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + low[:, b * ROWS + r])
        band[:, b] = key
    bits = np.zeros((len(full), _LONGS * _PER_LONG), np.uint64)
    bits[:, : BANDS * ROWS] = mix(low) & np.uint64(2**BITS - 1)
    packed = np.bitwise_or.reduce(bits.reshape(len(full), _LONGS, _PER_LONG) << (np.arange(_PER_LONG, dtype=np.uint64) * np.uint64(BITS)), axis=2)
    digests = np.zeros((2, len(count)), np.uint64)
    if len(full):
        digests[0, full] = np.add.reduceat(mix(sets), at[:-1])
        digests[1, full] = np.add.reduceat(mix(sets ^ np.uint64(0xD1B54A32D192ED03)), at[:-1])

    def lists(values: np.ndarray) -> pa.ListArray:
        width = np.zeros(len(count) + 1, np.int32)
        width[1:][full] = values.shape[1]
        return pa.ListArray.from_arrays(pa.array(np.cumsum(width), pa.int32()), pa.array(values.reshape(-1).view(np.int64)))

    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(count, pa.int64()), pa.array(digests[0].view(np.int64)), pa.array(digests[1].view(np.int64)), lists(band), lists(packed)], names=[f.split()[0] for f in SKETCH.split(", ")])


def sketches(docs: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = SHINGLE) -> DataFrame:
    """One scan of the texts: see ``SKETCH``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE):
            yield _sketch(batch, k)

    return _keyed(docs, key, text).mapInArrow(run, SKETCH)


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """A row is told from others by its id and its text (a hash of it); rows equal in both are one document."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))


def full_sets(texts: DataFrame, k: int) -> DataFrame:
    """``id`` and all its shingles, sorted, from ``id, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE):
            sets, first = shingles(words(batch.column("text"), lower=True), k)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(sets.view(np.int64)))], names=["id", "shingles"])

    return texts.select("id", "text").mapInArrow(run, "id long, shingles array<long>")


def estimate(a: Column, b: Column) -> Column:
    """Similarity by equal slots, corrected for slots whose low bits agree by chance."""
    unlike = F.lit(0)
    for i in range(_LONGS):
        x = a[i].bitwiseXOR(b[i])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseAND(F.lit(_ONES))
        unlike = unlike + F.bit_count(x)
    equal = F.lit(1.0) - unlike / F.lit(float(BANDS * ROWS))
    return (equal - 2.0**-BITS) / (1 - 2.0**-BITS)


def _possible(shared: Column, n: Column, other: Column, percent: int) -> Column:
    """Whether sets of ``n`` and ``other`` elements that have ``shared`` or fewer in common can be a link."""
    return shared * 100 >= (n + other - shared) * percent


def _confirmed(pairs: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (``a``, ``b``) that are links. The tables are read from the shared folder, so Spark can split a hot ``b``."""
    margin = 6 * (percent / 100 * (1 - percent / 100) / (BANDS * ROWS)) ** 0.5
    side = lambda c: members.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.col("own").alias(f"own_{c}"), F.col("signature").alias(f"s_{c}"))
    near = (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .filter(_possible(F.least(F.col("n_a") - F.col("own_a"), F.col("n_b") - F.col("own_b")), F.col("n_a"), F.col("n_b"), percent))
        .filter(estimate(F.col("s_a"), F.col("s_b")) >= percent / 100 - margin)
        .select("a", "b")
    )
    near = written(near)
    both = near.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return written(both.filter(_possible(shared, F.size("x"), F.size("y"), percent)).select("a", "b"))


def _heads(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``id, n, own, head, last``: each member's rarest shared shingles in an order common to all, and the place of the last.

    A shingle of another's that comes no later than the own head's last is in
    that head or not in the set at all.
    """
    each = members.join(sets, "id").select("id", "n", "own", F.explode("shingles").alias("s"))
    often = written(each.groupBy("s").agg(F.count(F.lit(1)).alias("often")).filter("often > 1"))
    shared = each.join(often, "s")
    alone = members.select("id", "n", "own").join(shared.groupBy("id").agg(F.count(F.lit(1)).alias("shared")), "id").select("id", "n", (F.col("n") - F.col("shared")).alias("own"))
    first = shared.withColumn("place", F.row_number().over(W.partitionBy("id").orderBy("often", "s"))).filter(F.col("place") <= HEAD)
    heads = first.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("often", "s"))).alias("h"))
    return alone.join(heads, "id").select("id", "n", "own", F.col("h.s").alias("head"), F.element_at("h", -1).alias("last"))


def groups(docs: DataFrame, *, key: str = "doc_id", text: str = "text", percent: int = 80, k: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: every row with the smallest id its links reach.

    Linked are documents with ``100 * intersection >= percent * union`` of
    their shingle sets; words are lower-cased (A-Z) runs without ASCII white
    space. Null and wordless texts are linked with nothing. Rows with a null id
    are linked with nothing, have a null component and are kept. Rows that
    share an id but not a text are documents of their own, each linked by its
    own text; other columns, whatever their names, are ignored, and an empty
    table gives no rows.
    """
    return _numbered(docs, key=key, text=text, percent=percent, k=k).select("doc_id", "n_shingles", "component_id", "kept")


def _numbered(docs: DataFrame, *, key: str, text: str, percent: int, k: int = SHINGLE) -> DataFrame:
    """``groups`` with ``text_hash``. Inside, rows go by a number that is written with their sketches."""
    all_rows = written(sketches(docs, key=key, text=text, k=k).withColumn("row", F.monotonically_increasing_id()))
    rows = all_rows.filter("n_shingles > 0 and doc_id is not null")
    classes = written(rows.groupBy("digest_a", "digest_b", "n_shingles").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("copies")).filter("copies > 1").drop("copies"))
    copies = written(rows.join(classes, ["digest_a", "digest_b", "n_shingles"]).filter("row <> first").select("row", "first"))
    heads = rows.join(checked(copies.select("row")), "row", "left_anti")

    # Buckets with at least two representatives, and who is in them.
    banded = heads.select(F.col("row").alias("id"), F.explode("bands").alias("bucket"))
    shared = written(banded.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high").select("bucket"))
    inside = written(banded.join(shared, "bucket"))
    candidates = written(inside.select("id").distinct())
    if candidates.isEmpty():
        found = all_rows.sparkSession.createDataFrame([], "id long, component long")
    else:
        few = checked(candidates)
        named = written(rows.join(few.withColumnRenamed("id", "row"), "row", "left_semi").select(F.col("row").alias("id"), "doc_id", "text_hash"))
        texts = _keyed(docs, key, text).join(checked(named), ["doc_id", "text_hash"]).select("id", "text")
        sets = written(full_sets(texts, k).dropDuplicates(["id"]))
        alone = sets.select("id", F.explode("shingles").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("c"), F.min("id").alias("id")).filter("c = 1").groupBy("id").agg(F.count(F.lit(1)).alias("own"))
        members = written(
            rows.join(few.withColumnRenamed("id", "row"), "row", "left_semi")
            .select(F.col("row").alias("id"), F.col("n_shingles").alias("n"), "signature")
            .join(alone, "id", "left")
            .na.fill(0, ["own"])
            .filter(_possible(F.col("n") - F.col("own"), F.col("n"), F.col("n") - F.col("own"), percent))
        )
        viable = written(inside.join(members.select("id", "n", "own"), "id"))
        least = written(viable.groupBy("bucket").agg(F.min("n").alias("least")))
        core = F.col("n") - F.col("own")
        viable = written(viable.join(least, "bucket").filter(_possible(core, F.col("n"), F.greatest("least", core), percent)).drop("least"))
        centres = written(viable.groupBy("bucket").agg(F.min(F.struct("own", "id")).alias("m"), F.count(F.lit(1)).alias("c")).filter("c > 1").select("bucket", F.col("m.id").alias("b")))
        spokes = viable.join(centres, "bucket").filter("id <> b").select(F.col("id").alias("a"), "b").distinct()
        edges = _confirmed(spokes, members, sets, percent)
        found = components(edges)

        # Members of one bucket that are still apart.
        placed = written(viable.join(written(found), "id", "left").withColumn("component", F.coalesce("component", "id")))
        split = written(placed.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("bucket"))
        apart = written(placed.join(split, "bucket").select("bucket", "id", "component"))
        known = written(_heads(apart.select("id").distinct().join(members, "id"), sets).join(rows.select(F.col("row").alias("id"), "bands"), "id"))
        known = apart.join(known, "id")
        left, right = (known.select("bucket", *[F.col(c).alias(f"{c}_{side}") for c in known.columns if c != "bucket"]) for side in "ab")
        reach = F.least(F.col("n_a") - F.col("own_a"), F.col("n_b") - F.col("own_b"))
        # What stands behind the head that ends first can be shared too, but nothing more of that head.
        tail = F.when(F.col("last_a") <= F.col("last_b"), F.col("n_a") - F.size("head_a") - F.col("own_a")).otherwise(F.col("n_b") - F.size("head_b") - F.col("own_b"))
        rest = left.join(
            right,
            (left["bucket"] == right["bucket"])
            & (F.col("id_a") < F.col("id_b"))
            & (F.col("component_a") != F.col("component_b"))
            & _possible(reach, F.col("n_a"), F.col("n_b"), percent)
            & (F.get(F.array_intersect("bands_a", "bands_b"), 0) == left["bucket"])  # a pair is made in the first bucket that it shares
            & _possible(F.size(F.array_intersect("head_a", "head_b")) + tail, F.col("n_a"), F.col("n_b"), percent),
        )
        more = _confirmed(rest.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct(), members, sets, percent)
        if not more.isEmpty():
            found = components(edges.union(more))
    out = all_rows.select("row", "doc_id", "text_hash", "n_shingles").join(copies, "row", "left").withColumn("id", F.coalesce("first", "row"))
    out = written(out.join(found, "id", "left").withColumn("component", F.coalesce("component", "id")).drop("id", "first"))
    several = written(out.groupBy("component").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("members")).filter("members > 1").drop("members"))
    whole = out.join(checked(several), "component", "left").withColumn("component_id", F.coalesce("low", "doc_id"))
    return whole.select("doc_id", "text_hash", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, *, key: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """``docs`` with the first document of each group only: rows that are not kept go, by their ids and texts.

    Rows without an id, and null and wordless texts, stay. All columns stay as
    they are, whatever their names.
    """
    gone = written(_numbered(docs, key=key, text=text, percent=percent).filter("not kept").select("doc_id", "text_hash").distinct())
    new = [free_name(c, docs) for c in gone.columns]
    gone = checked(gone.toDF(*new))
    return docs.join(gone, (docs[key].cast("long") == gone[new[0]]) & (F.xxhash64(docs[text]) == gone[new[1]]), "left_anti")
