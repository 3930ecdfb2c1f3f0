"""The network's scores against loops over single words and steps, and its accuracy on labels that it never saw."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from moraine.llm import queries, toxicity
from moraine.llm.words import words

MASK = (1 << 64) - 1


def mixed(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ (x >> 31)


def vector(p, word, code):
    out = p["word"][code % toxicity.BUCKETS].astype(float).copy()
    raw = b"\x01" + word + b"\x01"
    rows = []
    for k in toxicity.NGRAMS:
        for i in range(len(raw) - k + 1):
            key = k
            for b in raw[i : i + k]:
                key = (key * 0x100000001B3 + b) & MASK
            rows.append(p["char"][mixed(key) % toxicity.BUCKETS].astype(float))
    return out + (sum(rows) / len(rows) if rows else 0)


def plain_score(p, text):
    w = words(pa.array([text], pa.string()), alnum=True)
    n, h = len(w.hash), toxicity.HIDDEN
    if not n:
        return float(p["prior"][0])
    spelt = [bytes(w.buffer[a:b]) for a, b in zip(w.start, w.end)]
    gates = [vector(p, s, int(c)) @ p["input"] + p["bias"] for s, c in zip(spelt, w.hash)]
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    starts = sorted({min(s, max(0, n - toxicity.WINDOW)) for s in range(0, max(1, n - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE)})
    best = -math.inf
    for a in starts:
        steps = range(a, min(a + toxicity.WINDOW, n))
        states = {t: [] for t in steps}
        for d in (0, 1):
            state, weight = [0.0] * h, p["state"][d]
            for t in steps if d == 0 else reversed(steps):
                g = gates[t][3 * h * d : 3 * h * (d + 1)]
                u = [sum(state[i] * float(weight[i][j]) for i in range(h)) for j in range(3 * h)]
                new = []
                for j in range(h):
                    z, r = sigmoid(g[j] + u[j]), sigmoid(g[h + j] + u[h + j])
                    candidate = math.tanh(g[2 * h + j] + r * u[2 * h + j])
                    new.append((1 - z) * candidate + z * state[j])
                state = new
                states[t] += state
        weights = [math.exp(sum(x * float(y) for x, y in zip(states[t], p["attend"]))) for t in steps]
        pooled = [sum(a_ * states[t][j] for a_, t in zip(weights, steps)) / sum(weights) for j in range(2 * h)]
        best = max(best, sum(x * float(y) for x, y in zip(pooled, p["out"])) + float(p["level"][0]))
    return sigmoid(best)


def test_scores_by_plain_loops():
    rng, random_ = np.random.default_rng(0), random.Random(0)
    p = toxicity.parameters(rng)
    for name in ("word", "char"):
        p[name] = (rng.standard_normal(p[name].shape) * 0.5).astype(np.float32)
    p["bias"] = (rng.standard_normal(p["bias"].shape) * 0.2).astype(np.float32)
    p["prior"] = np.array([0.125], np.float32)
    pool = ["a", "the", "zzork", "naïve", "日本", "x1", "Longer", "words-joined"]
    texts = [None, "", " ... ", "a", *[" ".join(random_.choice(pool) for _ in range(n)) for n in (2, 31, 32, 33, 48, 49, 90)]]
    got = toxicity.score_texts(p, pa.array(texts, pa.string()))
    assert got == pytest.approx([plain_score(p, t) for t in texts], abs=2e-4)


def test_accuracy_on_labels_that_were_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = queries.op5_toxicity(spark, sf).filter("held_out").join(labels, "doc_id").filter("toxic is not null").select("score", "toxic", "predicted").collect()
    toxic, clean = ([r["score"] for r in rows if r["toxic"] == y] for y in (1, 0))
    assert len(toxic) > 50 and len(clean) > 500
    rank = {s: i for i, s in enumerate(sorted({*toxic, *clean}))}
    order = np.array([rank[s] for s in clean])
    auc = np.mean([(order < rank[s]).mean() + (order == rank[s]).mean() / 2 for s in toxic])
    assert auc >= 0.9  # 0.957; with 329 toxic labels to learn from the threshold finds 0.85 of the held-out ones
    assert np.mean([r["predicted"] == 1 for r in rows if r["toxic"] == 0]) <= 0.05


def test_clashing_columns_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b", 0.5, True), (1, "a b", 0.5, True), (None, None, None, None)], "doc_id long, text string, score double, held_out boolean").withColumn("toxic", F.lit(9)).withColumn("predicted", F.lit("x"))
    labels = spark.createDataFrame([(1, 1, "q"), (1, 0, "q"), (2, 0, "q")], "doc_id long, toxic int, text string")
    found = toxicity.scores(docs, labels).collect()
    assert len(found) == 3 and len({r["score"] for r in found if r["doc_id"] == 1}) == 1
    assert toxicity.without_toxic(docs, labels).columns == docs.columns
