"""Removal of repeated word windows by recompression.

Two rounds of pair compression turn a document's words into symbols: each
round deals its symbols into left and right classes by a bit of their names,
and every left symbol followed by a right one becomes a new symbol named after
the pair. Names are 64-bit values made from the content alone, so all tasks
agree on them without a dictionary, and equal substrings have equal interior
symbols: whether two neighbours pair depends on nothing but those two. Runs of
one word need no naming of their own, as equal neighbours share a class and so
never pair; a run stays a run of equal symbols, inside a window as outside.

A symbol of round two spans at most four words, so a window of 20 words holds
whole symbols at least three words away from both its ends, which no context
outside the window can change. The longest of them (ties: largest name, then
leftmost) speaks for the window. Windows are sent to the place of their
symbol's name, where equal windows meet whatever document they are in; the
first one of each kind stays. Windows that repeat within one task's piece are
settled there, so a passage that a third of all documents share reaches its
place once per piece and not once per document.

A window is compared by its symbol's name and all 64 bits of its own hash, in
a task's piece as at the place of its name. Different windows may well share a
name, so only the hash counts for them: n different windows of one name have
about n * n / 2**65 falsely equal pairs (5e-5 for 44 million windows).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moraine.llm.common import free_name
from moraine.llm.words import grams, mix, slices, words

WINDOW = 20
#: Words at either end of a window whose symbols may depend on what stands outside.
MARGIN = 3
#: Longest symbol of round two, in words.
SPAN = 4
#: Bytes of text that a task compares at a time.
PIECE = 3_000_000

PAYLOAD = "bucket int, name binary, doc binary, start binary, count binary, hash binary, known_doc binary, known_begin binary, known_end binary"


def _pair(name: np.ndarray, joined: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """One round: indices of the new symbols' first members, and their names. ``joined``: stands in its predecessor's document."""
    left = (mix(name ^ np.uint64(salt)) & np.uint64(1)).astype(bool)
    into = np.zeros(len(name), bool)
    into[1:] = joined[1:] & left[:-1] & ~left[1:]
    first = np.flatnonzero(~into)
    size = np.diff(np.append(first, len(name)))
    two = size == 2
    new = name[first].copy()
    new[two] = mix(name[first[two]] * np.uint64(0xA0761D6478BD642F) + name[first[two] + 1] + np.uint64(salt))
    return first, new


def symbols(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Round-two symbols of all documents: first words and names."""
    joined = np.zeros(len(hashes), bool)
    joined[1:] = doc[1:] == doc[:-1]
    one, name = _pair(hashes, joined, 0x5851F42D4C957F2D)
    two, name = _pair(name, joined[one], 0x14057B7EF767814F)
    return one[two], name


def speakers(hashes: np.ndarray, doc: np.ndarray, size: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows' first words, the first words of the symbols that speak for them, and those symbols' names."""
    n = len(hashes)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first, name = symbols(hashes, doc)
    total = np.concatenate([[0], np.cumsum(size)])
    length = np.minimum(total[np.append(first[1:], n)] - total[first], 255).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    key[first] = (length << np.uint64(56)) | (name >> np.uint64(8))
    named = np.zeros(n, np.uint64)
    named[first] = name
    reach = window - 2 * MARGIN - SPAN + 1
    best = key
    done = 1
    while done < reach:  # sliding maximum by doubling
        step = min(done, reach - done)
        best = np.maximum(best[:-step], best[step:])
        done += step
    begin = np.flatnonzero(doc[: n - window + 1] == doc[window - 1 :])
    top = best[begin + MARGIN]
    at = np.zeros(len(begin), np.int64)
    for k in reversed(range(reach)):
        here = begin + MARGIN + k
        same = key[here] == top
        at[same] = here[same]
    return begin, at, named[at]


def _not_first(order: np.ndarray, key: np.ndarray, name: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which windows have an equal one that starts earlier. ``order`` sorts by key, name, document and start."""
    k, n = key[order], name[order]
    head = np.concatenate([[True], (k[1:] != k[:-1]) | (n[1:] != n[:-1])])
    group = np.flatnonzero(head)[np.cumsum(head) - 1]
    later = np.empty(len(key), bool)
    later[order] = (doc[order] != doc[order][group]) | (start[order] != start[order][group])
    return later


def _merged(doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of one length class joined per document where they touch."""
    order = np.lexsort((begin, doc))
    doc, begin, end = doc[order], begin[order], end[order]
    if len(doc) == 0:
        return doc, begin, end
    head = np.concatenate([[True], (doc[1:] != doc[:-1]) | (begin[1:] > np.maximum(end[:-1], 0))])
    at = np.flatnonzero(head)
    return doc[at], begin[at], np.maximum.reduceat(end, at)


def _piece(batch: pa.RecordBatch, window: int, buckets: int) -> pa.RecordBatch:
    ids = np.asarray(batch.column("doc_id"))
    order = np.argsort(ids, kind="stable")
    batch, ids = batch.take(pa.array(order)), ids[order]
    w = words(batch.column("text"))
    begin, at, name = speakers(w.hash, w.doc, w.end - w.start, window)
    doc, start = ids[w.doc[begin]], (begin - w.first[w.doc[begin]]).astype(np.int32)
    whole = grams(w.hash, window)[begin] if len(begin) else np.zeros(0, np.uint64)
    later = _not_first(np.lexsort((name, whole)), whole, name, doc, start) if len(begin) else np.zeros(0, bool)
    # Neighbouring windows with one speaker travel together.
    head = np.flatnonzero(np.concatenate([[True], (np.diff(begin) != 1) | (np.diff(at) != 0)])) if len(begin) else np.zeros(0, np.int64)
    count = np.diff(np.append(head, len(begin)))
    settled = np.minimum.reduceat(later, head) if len(head) else np.zeros(0, bool)
    k_doc, k_begin, k_end = _merged(doc[head[settled]], start[head[settled]], start[head[settled]] + (count[settled] + window - 1).astype(np.int32))
    head, count = head[~settled], count[~settled]
    place = (name[head] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(place, kind="stable")
    head, count, place = head[order], count[order], place[order]
    which = np.repeat(head - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    raw = whole[which]
    cuts = np.searchsorted(place, np.arange(buckets + 1))
    upto = np.concatenate([[0], np.cumsum(count)])
    k_place = (mix(k_doc.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    k_order = np.argsort(k_place, kind="stable")
    k_doc, k_begin, k_end = k_doc[k_order], k_begin[k_order], k_end[k_order]
    k_cuts = np.searchsorted(k_place[k_order], np.arange(buckets + 1))
    names, docs, starts, counts = name[head], doc[head].astype(np.int64), start[head], count.astype(np.uint8)
    rows: dict[str, list] = {f.split()[0]: [] for f in PAYLOAD.split(", ")}
    for b in np.flatnonzero((np.diff(cuts) > 0) | (np.diff(k_cuts) > 0)).tolist():
        x, y, p, q = cuts[b], cuts[b + 1], k_cuts[b], k_cuts[b + 1]
        values = (b, names[x:y].tobytes(), docs[x:y].tobytes(), starts[x:y].tobytes(), counts[x:y].tobytes(), raw[upto[x] : upto[y]].tobytes(), k_doc[p:q].astype(np.int64).tobytes(), k_begin[p:q].astype(np.int32).tobytes(), k_end[p:q].astype(np.int32).tobytes())
        for column, value in zip(rows, values):
            rows[column].append(value)
    return pa.RecordBatch.from_arrays([pa.array(rows["bucket"], pa.int32()), *[pa.array(v, pa.binary()) for k, v in rows.items() if k != "bucket"]], names=list(rows))


def _meet(group: pd.DataFrame, window: int) -> pd.DataFrame:
    """Windows of one bucket of names: the spans of all that have an earlier equal."""

    def column(name: str, kind) -> np.ndarray:
        return np.frombuffer(b"".join(group[name]), dtype=kind)

    name, doc, start, count = column("name", np.uint64), column("doc", np.int64), column("start", np.int32), column("count", np.uint8).astype(np.int64)
    raw = column("hash", np.uint64)
    order = np.argsort(name, kind="stable")
    same = name[order][1:] == name[order][:-1]
    shared = np.zeros(len(name), bool)
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    pick = np.flatnonzero(shared)
    n = count[pick]
    inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    which = np.repeat((np.cumsum(count) - count)[pick], n) + inside
    key, named = raw[which], np.repeat(name[pick], n)
    of, at = np.repeat(doc[pick], n), (np.repeat(start[pick], n) + inside).astype(np.int32)
    later = _not_first(np.lexsort((at, of, named, key)), key, named, of, at) if len(key) else np.zeros(0, bool)
    known = [column("known_doc", np.int64), column("known_begin", np.int32), column("known_end", np.int32)]
    found = [of[later], at[later], at[later] + np.int32(window)]
    d, b, e = _merged(*[np.concatenate(x) for x in zip(known, found)])
    return pd.DataFrame({"doc_id": d, "begin": b.astype(np.int32), "end": e.astype(np.int32)})


def repeated_spans(docs: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``doc_id, begin, end``: spans of words covered by windows that also start earlier; spans of a document may overlap.

    Rows with a null id or text have no windows. Rows that repeat an id count
    as one document: a window is never its own earlier copy.
    """
    if window < 2 * MARGIN + 2 * SPAN:
        raise ValueError(f"a window of fewer than {2 * MARGIN + 2 * SPAN} words may hold no symbol of its own")
    buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE):
            yield _piece(batch, window, buckets)

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).filter("doc_id is not null and text is not null")
    return rows.mapInArrow(pieces, PAYLOAD).groupBy("bucket").applyInPandas(lambda g: _meet(g, window), "doc_id long, begin int, end int")


def _kept(text: str | None, begins: list[int] | None, ends: list[int] | None) -> tuple[int, int, bytes, list[bytes]]:
    parts = (text or "").encode("utf-8", "surrogatepass").split()
    if not begins:
        return len(parts), 0, b" ".join(parts), parts
    drop = np.zeros(len(parts) + 1, np.int64)
    np.add.at(drop, np.minimum(begins, len(parts)), 1)
    np.add.at(drop, np.minimum(ends, len(parts)), -1)
    keep = np.cumsum(drop)[:-1] == 0
    kept = [p for p, k in zip(parts, keep.tolist()) if k]
    return len(parts), len(parts) - len(kept), b" ".join(kept), kept


def _with_spans(docs: DataFrame, names: tuple[str, str], *, key: str, text: str, window: int) -> DataFrame:
    """``docs`` with two columns more, ``names``: where the repeated spans of a row's document begin and end."""
    own = free_name("key", docs)
    spans = repeated_spans(docs, key=key, text=text, window=window).groupBy("doc_id").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    spans = spans.select(F.col("doc_id").alias(own), F.col("spans.begin").alias(names[0]), F.col("spans.end").alias(names[1]))
    return docs.join(spans.hint("shuffle_hash"), F.col(key).cast("long") == F.col(own), "left").drop(own)


def deduplicate(docs: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row.

    The digest is that of the kept words joined by one space (of nothing: the
    empty string's). Null texts have no words; rows with a null id keep all.
    Other columns, whatever their names, are ignored; an empty table gives no
    rows.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    joined = _with_spans(rows, ("begins", "ends"), key="doc_id", text="text", window=window)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE):
            out = [_kept(*row) for row in zip(*[batch.column(c).to_pylist() for c in ("text", "begins", "ends")])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([hashlib.sha256(x[2]).hexdigest() for x in out])], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return joined.mapInArrow(digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated words gone from ``text``; texts that lose none stay as they are, the others' words are joined by one space.

    Rows with a null id or text stay as they are; all other columns do too,
    whatever their names. A text all of whose words go becomes empty.
    """
    begin, end = free_name("begins", docs), free_name("ends", docs)
    joined = _with_spans(docs, (begin, end), key=key, text=text, window=window)
    schema = docs.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, PIECE):
            texts, begins, ends = (batch.column(c).to_pylist() for c in (text, begin, end))
            new = [_kept(t, b, e)[2].decode("utf-8", "surrogatepass") if b else t for t, b, e in zip(texts, begins, ends)]
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if f.name == text else batch.column(f.name) for f in schema], names=schema.names)

    return joined.select(*docs.columns, begin, end).mapInArrow(cut, schema)
