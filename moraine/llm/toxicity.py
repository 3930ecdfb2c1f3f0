"""Toxicity scores from a small bidirectional gated recurrent network in numpy.

A word's input is the embedding of its hash plus the mean embedding of its
hashed character n-grams, so spellings that share a stem share most of their
input. Two gated recurrent layers, forward and backward, read windows of
``WINDOW`` words that overlap by half; attention pools their states, and a
document's score is that of its most toxic window. All windows of all
documents are scored.

The network is fitted on the driver on a bounded sample of labelled rows
(``Fit``), as multiple instances: a document's label belongs to its strongest
window. Its parameters, a few MB whatever the corpus, go to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moraine.llm.common import written
from moraine.llm.words import Words, mix, slices, words

WINDOW = 32
STRIDE = 16
DIM = 16
HIDDEN = 8
BUCKETS = 1 << 15
NGRAMS = (3, 4, 5)
PIECE = 2_000_000
THRESHOLD = 0.3


@dataclass(frozen=True)
class Fit:
    """Bounds of the training sample and of the training itself."""

    #: Most labelled ids learned from of either class, and most bytes of a text that is learned from.
    positives: int = 1500
    negatives: int = 3000
    text_bytes: int = 2500
    epochs: int = 6
    batch: int = 64
    rate: float = 0.01
    seed: int = 7
    #: Documents of the sample that a word or n-gram must stand in to be learned.
    documents: int = 4


def parameters(rng: np.random.Generator) -> dict[str, np.ndarray]:
    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    return {
        # What the sample doesn't have stays at 0, which says nothing either way.
        "word": np.zeros((BUCKETS, DIM), np.float32),
        "char": np.zeros((BUCKETS, DIM), np.float32),
        "input": normal(DIM, 6 * HIDDEN, scale=DIM**-0.5),
        "bias": np.zeros(6 * HIDDEN, np.float32),
        "state": normal(2, HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
        "attend": normal(2 * HIDDEN, scale=0.1),
        "out": normal(2 * HIDDEN, scale=HIDDEN**-0.5),
        "level": np.zeros(1, np.float32),
    }


@dataclass
class Vocabulary:
    """The distinct words of some texts: their embedding rows, and their n-grams' (``gram``, owner in ``of``)."""

    word: np.ndarray
    gram: np.ndarray
    of: np.ndarray
    share: np.ndarray


def vocabulary(w: Words) -> tuple[Vocabulary, np.ndarray]:
    """The distinct words, and which of them stands at each place."""
    hashes, at, which = np.unique(w.hash, return_index=True, return_inverse=True)
    start, size = w.start[at], w.end[at] - w.start[at]
    n = len(hashes)
    padded = np.cumsum(size + 2) - (size + 2)
    text = np.full(int((size + 2).sum()), 1, np.uint64)  # byte 1 marks both ends of a word
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    text[np.repeat(padded + 1, size) + inside] = w.buffer[np.repeat(start, size) + inside]
    owner = np.repeat(np.arange(n), size + 2)
    grams, of = [], []
    for k in NGRAMS:
        if len(text) < k:
            continue
        whole = owner[: len(owner) - k + 1] == owner[k - 1 :]
        key = np.full(len(whole), k, np.uint64)
        for j in range(k):
            key = key * np.uint64(0x100000001B3) + text[j : j + len(whole)]
        grams.append((mix(key[whole]) % np.uint64(BUCKETS)).astype(np.int64))
        of.append(owner[: len(whole)][whole])
    gram, of = (np.concatenate(grams), np.concatenate(of)) if grams else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    order = np.argsort(of, kind="stable")
    gram, of = gram[order], of[order]
    count = np.bincount(of, minlength=n)
    return Vocabulary((hashes % np.uint64(BUCKETS)).astype(np.int64), gram, of, (1 / np.maximum(count, 1)).astype(np.float32)), which


def inputs(p: dict[str, np.ndarray], v: Vocabulary, block: int = 20_000) -> np.ndarray:
    """Input vectors of the distinct words; n-grams are summed a block of words at a time."""
    x = p["word"][v.word]
    for a in range(0, len(x), block):
        lo, hi = np.searchsorted(v.of, (a, a + block))
        if lo < hi:
            of = v.of[lo:hi]
            head = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            x[of[head]] += np.add.reduceat(p["char"][v.gram[lo:hi]], head, axis=0) * v.share[of[head], None]
    return x


def windows(first: np.ndarray, window: int = WINDOW, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """All overlapping windows: first word of each, and its document; the last one ends with the document."""
    size = np.diff(first)
    count = np.where(size == 0, 0, 1 + np.maximum(0, -(-(size - window) // stride)))
    doc = np.repeat(np.arange(len(size)), count)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    return np.minimum(first[:-1][doc] + k * stride, np.maximum(first[1:][doc] - window, first[:-1][doc])), doc


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def forward(p: dict[str, np.ndarray], gates: np.ndarray, places: np.ndarray, filled: np.ndarray, keep: bool = False):
    """Logits of windows. ``places``: rows of ``gates`` per window and step; ``filled``: the steps that hold a word."""
    b, steps = places.shape
    hidden = np.zeros((b, steps, 2 * HIDDEN), np.float32)
    kept = []
    for d in (0, 1):
        h = np.zeros((b, HIDDEN), np.float32)
        weight, part = p["state"][d], slice(3 * HIDDEN * d, 3 * HIDDEN * (d + 1))
        for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
            g, u = gates[places[:, t], part], h @ weight
            zr = _sigmoid(g[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
            z, r, un = zr[:, :HIDDEN], zr[:, HIDDEN:], u[:, 2 * HIDDEN :]
            n = np.tanh(g[:, 2 * HIDDEN :] + r * un)
            on = filled[:, t, None]
            new = np.where(on, n + z * (h - n), h)
            if keep:
                kept.append((d, t, h, z, r, un, n, on))
            h = new
            hidden[:, t, HIDDEN * d : HIDDEN * (d + 1)] = h
    a = np.where(filled, hidden @ p["attend"], -1e9)
    a = np.exp(a - a.max(axis=1, keepdims=True))
    a /= a.sum(axis=1, keepdims=True)
    pooled = (a[:, :, None] * hidden).sum(axis=1)
    logits = pooled @ p["out"] + p["level"][0]
    return (logits, hidden, a, pooled, kept) if keep else logits


def backward(p: dict[str, np.ndarray], gates: np.ndarray, places: np.ndarray, cache, slope: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Gradients of the parameters and of ``gates``; ``slope``: the loss's by each logit."""
    _, hidden, a, pooled, kept = cache
    grad = {"out": pooled.T @ slope, "level": slope.sum(keepdims=True)}
    d_pool = slope[:, None] * p["out"]
    d_a = (hidden * d_pool[:, None]).sum(axis=2)
    d_score = a * (d_a - (a * d_a).sum(axis=1, keepdims=True))
    grad["attend"] = np.einsum("bt,bth->h", d_score, hidden)
    d_hidden = a[:, :, None] * d_pool[:, None] + d_score[:, :, None] * p["attend"]
    d_gates, d_state = np.zeros_like(gates), np.zeros_like(p["state"])
    carry = [np.zeros((len(places), HIDDEN), np.float32) for _ in (0, 1)]
    for d, t, h, z, r, un, n, on in reversed(kept):
        dh = d_hidden[:, t, HIDDEN * d : HIDDEN * (d + 1)] + carry[d]
        live = np.where(on, dh, 0)
        dn = live * (1 - z) * (1 - n * n)
        dz = live * (h - n) * z * (1 - z)
        dr = dn * un * r * (1 - r)
        du = np.concatenate([dz, dr, dn * r], axis=1)
        d_state[d] += h.T @ du
        carry[d] = np.where(on, live * z, dh) + du @ p["state"][d].T
        np.add.at(d_gates, (places[:, t], slice(3 * HIDDEN * d, 3 * HIDDEN * (d + 1))), np.concatenate([dz, dr, dn], axis=1))
    grad["state"] = d_state
    return grad, d_gates


def _laid(first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    begin, doc = windows(first)
    at = begin[:, None] + np.arange(WINDOW)
    filled = at < first[1:][doc][:, None]
    return which[np.minimum(at, len(which) - 1)] if len(which) else at, filled, doc


def train(texts: list[str], labels: list[int], fit: Fit = Fit(), prior: float | None = None) -> dict[str, np.ndarray]:
    """The parameters; with only one label in the sample, a network that always answers with its share.

    ``prior``: the share of toxic rows where the sample, which is drawn by class, doesn't have it.
    """
    rng = np.random.default_rng(fit.seed)
    p = parameters(rng)
    y = np.array(labels, np.float32)
    p["prior"] = np.array([prior if prior is not None else y.mean() if len(y) else 0.0], np.float32)
    if len(y) == 0 or y.min() == y.max():
        p["flat"] = np.ones(1, np.float32)
        return p
    names = ["word", "char", "input", "bias", "state", "attend", "out", "level"]
    m, s = ({k: np.zeros_like(p[k]) for k in names} for _ in range(2))
    weight = np.where(y == 1, 1.0, min(1.0, 2 * y.mean() / (1 - y.mean()))).astype(np.float32)
    step = 0
    epochs = max(fit.epochs, min(30, 9000 // len(y)))  # small samples are read more often
    seen = {name: np.zeros(BUCKETS, np.int64) for name in ("word", "char")}
    parts = []
    for i, text in enumerate(texts):
        w = words(pa.array([text], pa.string()), alnum=True)
        if len(w.hash):
            parts.append(i)
            v = vocabulary(w)[0]
            seen["word"][np.unique(v.word)] += 1
            seen["char"][np.unique(v.gram)] += 1
    learned = {name: (n >= fit.documents).astype(np.float32)[:, None] for name, n in seen.items()}
    for epoch in range(epochs):
        order = rng.permutation(parts)
        for k in range(0, len(order), fit.batch):
            rows = order[k : k + fit.batch]
            w = words(pa.array([texts[i] for i in rows], pa.string()), alnum=True)
            v, which = vocabulary(w)
            x = inputs(p, v)
            gates = x @ p["input"] + p["bias"]
            places, filled, doc = _laid(w.first, which)
            logits = forward(p, gates, places, filled)
            best = np.lexsort((logits, doc))[np.append(np.flatnonzero(np.diff(doc)), len(doc) - 1)]  # each document's strongest window
            cache = forward(p, gates, places[best], filled[best], keep=True)
            slope = ((_sigmoid(cache[0]) - y[rows]) * weight[rows] / len(rows)).astype(np.float32)
            grad, d_gates = backward(p, gates, places[best], cache, slope)
            grad["input"], grad["bias"] = x.T @ d_gates, d_gates.sum(axis=0)
            d_x = d_gates @ p["input"].T
            grad["word"], grad["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
            np.add.at(grad["word"], v.word, d_x)
            hot = np.flatnonzero(np.abs(d_x).sum(axis=1)[v.of] > 0)
            np.add.at(grad["char"], v.gram[hot], (d_x * v.share[:, None])[v.of[hot]])
            step += 1
            rate = fit.rate * (1 - 0.9 * epoch / epochs)
            for name in names:
                g = grad[name].astype(np.float32) * learned.get(name, 1)
                m[name] += 0.1 * (g - m[name])
                s[name] += 0.01 * (g * g - s[name])
                p[name] -= rate * (m[name] / (1 - 0.9**step)) / (np.sqrt(s[name] / (1 - 0.99**step)) + 1e-6)
    return p


def score_texts(p: dict[str, np.ndarray], texts: pa.Array, block: int = 4096) -> np.ndarray:
    """Scores of whole texts; those without words get the share of toxic labels."""
    out = np.full(len(texts), p["prior"][0], np.float64)
    w = words(texts, alnum=True)
    if "flat" in p or not len(w.hash):
        return out
    v, which = vocabulary(w)
    gates = inputs(p, v) @ p["input"] + p["bias"]
    begin, doc = windows(w.first)
    top = np.full(len(texts), -np.inf)
    last = w.first[1:]
    for a in range(0, len(begin), block):
        at = begin[a : a + block, None] + np.arange(WINDOW)
        filled = at < last[doc[a : a + block]][:, None]
        np.maximum.at(top, doc[a : a + block], forward(p, gates, which[np.minimum(at, len(which) - 1)], filled))
    has = np.isfinite(top)
    out[has] = _sigmoid(top[has])
    return out


def held_out(key: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), *, key: str = "doc_id", text: str = "text") -> tuple[list[str], list[int], float]:
    """At most ``positives`` and ``negatives`` labelled rows that may be learned from, with short texts; and the toxic share of all such labels, whatever their texts.

    The bound on texts holds before ids are drawn: only ids and labels are joined for it.
    """
    known = labels.select(F.col(key).cast("long").alias("_id"), F.col("toxic").cast("int").alias("toxic")).filter(F.col("toxic").isin(0, 1) & F.col("_id").isNotNull() & ~held_out(F.col("_id")))
    prior = known.agg(F.avg("toxic")).first()[0] or 0.0
    short = docs.select(F.col(key).cast("long").alias("_id"), F.col(text).alias("t")).filter(F.octet_length("t").between(1, fit.text_bytes))
    known = written(known.join(short.select("_id"), "_id", "left_semi"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.when(F.col("toxic") == 1, min(1.0, fit.positives / max(1, counts.get(1, 0)))).otherwise(min(1.0, fit.negatives / max(1, counts.get(0, 0))))
    few = known.filter(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < share * 1_000_000).limit(2 * (fit.positives + fit.negatives))
    rows = short.join(F.broadcast(few), "_id").select("_id", "t", "toxic")
    got = sorted(rows.limit(2 * (fit.positives + fit.negatives)).collect())
    return [r["t"] for r in got], [r["toxic"] for r in got], prior


def fitted(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), **columns) -> dict[str, np.ndarray]:
    texts, toxic, prior = sample(docs, labels, fit, **columns)
    return train(texts, toxic, fit, prior)


def scores(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row, null, empty and repeated ones too.

    Texts are not shuffled. Without labels the score is 0; with one label only
    it is that label's share. Texts without words get the toxic share of all
    labels that are not held out. Rows with a null id are not held out (and
    never labelled).
    """
    shared = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels, fit, key=key, text=text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score_texts(shared.value, batch.column("text")))], names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), held_out(F.col(key)).alias("held_out"), F.col(text).alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))


def without_toxic(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents whose score reaches the threshold: a filter inside the scan."""
    shared = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels, fit, key=key, text=text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, PIECE):
            yield batch.filter(pa.array(score_texts(shared.value, batch.column(text)) < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
