"""Secrets in texts: known forms, and tokens that a battery of tests takes for random.

A candidate is a run of at least 20 letters, digits and ``+/_-``. Its encoding
is the smallest alphabet that holds it. Three tests ask whether its symbols
are drawn uniformly and independently from that alphabet: chi-squared on the
symbols' counts, the number of runs below and above the alphabet's middle, and
the serial correlation of neighbours. Fisher's sum of ``-2 ln p`` is small for
random tokens.

How small it must be follows from ordinary text: all letters of all texts,
written in every encoding and cut to every length of ``LENGTHS``, go through
the same battery. The share of them that looks as random as a candidate of the
same encoding and length is the candidate's p-value, and in each such stratum
Benjamini and Hochberg's rule keeps the share of false discoveries under
``RATE``. Short strata, where ordinary text passes the tests, find nothing by
themselves.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moraine.llm.words import slices

# The forms of the known secrets.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
#: Lengths at which ordinary text is tested; a candidate belongs to the largest that it reaches.
LENGTHS = (20, 24, 32, 40, 64, 128)
#: Encodings by size of alphabet; symbols in the order of their values, upper and lower case apart only where both can stand.
ALPHABETS = {
    "hex": b"0123456789abcdef",
    "base32": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": b"0123456789abcdefghijklmnopqrstuvwxyz",
    "base62": b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
STRATA = [(e, n) for e in ALPHABETS for n in LENGTHS]
#: The share of false discoveries that each stratum allows.
RATE = 0.01
#: A token that the battery itself rejects at 1e-4 (chi-squared, six degrees) is no discovery, however odd ordinary text is.
MOST = 27.86
#: Sums are counted in steps of 1 / STEPS up to the last bin.
STEPS, BINS = 4, 400
#: Bytes of text in hand at a time, and symbols in one matrix of the battery.
PIECE, SYMBOLS = 2_000_000, 32_000
#: Letters in hand at a time. Longer texts are cut at its multiples, where a row of each stratum ends.
BLOCK = 230_400

_CODES = {}
for _name, _symbols in ALPHABETS.items():
    _codes = np.zeros(256, np.int64)
    _codes[np.frombuffer(_symbols, np.uint8)] = np.arange(len(_symbols))
    _CODES[_name] = _codes
_CODES["base64"][[ord("-"), ord("_")]] = (62, 63)
_NOT_LETTERS = bytes(b for b in range(256) if not (65 <= b <= 90 or 97 <= b <= 122))
_Z = np.linspace(0, 38, 3801)
_UPPER = np.array([-math.log(math.erfc(z / math.sqrt(2)) / 2) for z in _Z])
_STEPS_UP = np.diff(_UPPER)


def upper_tail(z: np.ndarray) -> np.ndarray:
    """``-ln P(Z >= z)`` of the normal distribution; flat beyond 38."""
    place = np.minimum(np.abs(z), _Z[-1]) * 100
    i = np.minimum(place.astype(np.int64), len(_Z) - 2)
    out = _UPPER[i] + (place - i) * _STEPS_UP[i]
    below = np.flatnonzero(z < 0)
    if len(below):
        out[below] = -np.log1p(-np.exp(-out[below]))
    return out


def running(x: np.ndarray, k: int) -> list[np.ndarray]:
    """Sums up to each place of symbols, squares, products of neighbours, symbols above the alphabet's middle, and changes between below and above."""
    above = x >= k / 2
    parts = (x, x * x, x[:-1] * x[1:], above, above[1:] != above[:-1])
    return [np.concatenate((np.zeros(1, np.int64), np.cumsum(v, dtype=np.int64))) for v in parts]


def sums(upto: list[np.ndarray], starts: np.ndarray, n: int) -> list[np.ndarray]:
    """``running``'s sums over each row."""
    ends = starts + n
    return [u[ends - (i in (2, 4))] - u[starts] for i, u in enumerate(upto)]


# Both sums over a row of at most LENGTHS[-1] symbols, side by side in one number: those over symbols, and those over neighbours.
_FIELDS = ((0, (1 << 16) - 1), (16, (1 << 24) - 1), (40, (1 << 24) - 1))


@lru_cache
def _fields(k: int) -> tuple[np.ndarray, np.ndarray]:
    """What a symbol, and what two neighbours (``first * k + second``), add to ``packed``'s sums."""
    v = np.arange(k)
    above = (v >= k / 2).astype(np.int64)
    return v + (v * v << 16) + (above << 40), (v[:, None] * v + ((above[:, None] != above).astype(np.int64) << 40)).ravel()


def packed(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``running`` in two arrays instead of five. Differences over short rows are right even where a sum has run over."""
    one, two = _fields(k)
    alone, pairs = np.zeros(len(x) + 1, np.int64), np.zeros(max(1, len(x)), np.int64)
    np.cumsum(one[x], out=alone[1:])
    at = x[:-1] * k
    at += x[1:]
    np.cumsum(two[at], out=pairs[1:])
    return alone, pairs


def short_sums(upto: tuple[np.ndarray, np.ndarray], starts: np.ndarray, n: int) -> list[np.ndarray]:
    """``sums`` from ``packed``."""
    alone = upto[0][starts + n] - upto[0][starts]
    pairs = upto[1][starts + n - 1] - upto[1][starts]
    total, square, up = (alone >> s & m for s, m in _FIELDS)
    return [total, square, pairs & (1 << 40) - 1, up, pairs >> 40]


def squared(x: np.ndarray, starts: np.ndarray, n: int, k: int, keep: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """For each row the sum of its symbols' squared counts; and the counts, if they are to be kept (at most 255 each)."""
    squares = np.empty(len(starts), np.int64)
    kept = np.empty((len(starts) if keep else 0, k), np.uint8)
    step, rows = max(1, SYMBOLS // n), np.lib.stride_tricks.sliding_window_view(x, n) if len(x) >= n else x.reshape(0, n)
    for a in range(0, len(starts), step):
        at = rows[starts[a : a + step]]
        at += (np.arange(len(at)) * k)[:, None]
        counts = np.bincount(at.ravel(), minlength=len(at) * k).reshape(-1, k)
        squares[a : a + step] = np.einsum("ij,ij->i", counts, counts)
        if keep:
            kept[a : a + step] = counts
    return squares, kept


def doubled(counts: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``squared`` for rows of twice the length (at most 128), each of them a row of ``counts`` and the one after it."""
    both = np.empty((len(first), counts.shape[1]), np.uint8)
    squares = np.empty(len(first), np.int64)
    step = max(1, SYMBOLS // counts.shape[1])
    for a in range(0, len(first), step):
        some = first[a : a + step]
        two = counts[some] + counts[some + 1]
        both[a : a + step] = two
        wide = two.astype(np.uint16)
        squares[a : a + step] = np.einsum("ij,ij->i", wide, wide)
    return squares, both


def uniform(squares: np.ndarray, n: int, k: int) -> np.ndarray:
    """Sparse counts: the exact mean and variance under uniformity, matched by a scaled chi-squared, then Wilson and Hilferty's cube root."""
    chi = squares * (k / n) - n
    mean, var = k - 1.0, 2.0 * (k - 1) * (n - 1) / n
    df = 2 * mean * mean / var
    return upper_tail((np.cbrt(np.maximum(chi, 0) / mean) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))


def alternating(up: np.ndarray, changes: np.ndarray, n: int) -> np.ndarray:
    """Runs below and above the middle, given how many symbols are above."""
    mixed = up * (n - up)
    expected = 1 + 2.0 * mixed / n
    spread = np.sqrt(np.maximum((expected - 1) * (expected - 2) / (n - 1), 1e-9))
    return np.maximum(np.where(mixed > 0, upper_tail(np.abs(1 + changes - expected) / spread) - math.log(2), n * math.log(2)), 0)


@lru_cache
def _uniform(n: int, k: int) -> np.ndarray:
    return uniform(np.arange(n * n + 1), n, k)


@lru_cache
def _alternating(n: int) -> np.ndarray:
    return alternating(np.arange(n + 1)[:, None], np.arange(n), n).ravel()


def fisher(of_counts: np.ndarray, of_runs: np.ndarray, total: np.ndarray, square: np.ndarray, product: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Fisher's sum of the two tests at hand and the correlation of neighbours, about 1 / sqrt(n) wide and 1 / n low if there is none; ``ends``: the first and last symbols' sum."""
    # Both sums are n * n times the centred ones.
    width = n * (n * square - total * total)
    shared = n * n * product - n * total * (2 * total - ends) + (n - 1) * total * total
    correlated = np.where(width > 0, upper_tail(np.abs(shared / np.maximum(width, 1) + 1 / n) * math.sqrt(n)) - math.log(2), n * math.log(2))
    return 2 * (of_counts + of_runs + np.maximum(correlated, 0))


def battery(codes: np.ndarray, k: int) -> np.ndarray:
    """Fisher's sum over the three tests for each row of symbols ``0..k-1``."""
    x, n = codes.ravel(), codes.shape[1]
    starts = np.arange(len(codes)) * n
    total, square, product, up, changes = sums(running(x, k), starts, n)
    return fisher(uniform(squared(x, starts, n, k)[0], n, k), alternating(up, changes, n), total, square, product, x[starts] + x[starts + n - 1], n)


def encoding(token: bytes) -> tuple[str, bytes] | None:
    """The encoding of a token and its symbols; digits alone are no secret here."""
    symbols = token.rstrip(b"=")
    if not symbols.translate(None, b"0123456789"):
        return None
    for name in ("hex", "base32", "base36"):
        for cased in (symbols, symbols.lower()) if name != "base32" else (symbols,):
            if cased in (symbols, symbols.lower()) and (cased == symbols or symbols == symbols.upper()) and not cased.translate(None, ALPHABETS[name]):
                return name, cased
    if not symbols.translate(None, ALPHABETS["base62"]):
        return "base62", symbols
    return None if b"/" in symbols and (b"-" in symbols or b"_" in symbols) or b"+" in symbols and b"_" in symbols else ("base64", symbols)


def stratum(name: str, n: int) -> int:
    return STRATA.index((name, max(x for x in LENGTHS if x <= n)))


def bins(sums: np.ndarray) -> np.ndarray:
    return np.minimum(sums * STEPS, BINS).astype(np.int64)


def base32(parts: list[bytes]) -> np.ndarray:
    """The symbols of all parts, each part filled up with zeros to whole groups of five bytes."""
    five = np.frombuffer(b"".join([p + bytes(-len(p) % 5) for p in parts]), np.uint8).reshape(-1, 5)
    group = five[:, 0].astype(np.int64)
    for i in range(1, 5):
        group <<= 8
        group |= five[:, i]
    return (group[:, None] >> np.arange(35, -1, -5) & 31).ravel()


def ordinary(texts: Iterable[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """For every stratum the sums of the texts' letters, all of them written in its encoding and each text cut to its length from the start on."""
    parts = [letters[a : a + BLOCK] for t in texts for letters in (t.translate(None, _NOT_LETTERS),) for a in range(0, len(letters), BLOCK)]
    plain = b"".join(parts)
    if not plain:
        return
    sizes = np.array([len(p) for p in parts])
    for name, symbols in ALPHABETS.items():
        if name == "hex":
            whole = np.frombuffer(plain, np.uint8)
            x, lengths = np.stack((whole >> 4, whole & 15), axis=1).ravel().astype(np.int64), 2 * sizes
        elif name == "base32":
            x, lengths, spans = base32(parts), -(-8 * sizes // 5), 8 * -(-sizes // 5)
        elif name == "base64":
            written = [base64.b64encode(p).rstrip(b"=") for p in parts]
            x, lengths = _CODES[name][np.frombuffer(b"".join(written), np.uint8)], np.array([len(w) for w in written])
        else:
            x, lengths = _CODES[name][np.frombuffer(plain.lower() if name == "base36" else plain, np.uint8)], sizes
        k, upto, begins = len(symbols), packed(x, len(symbols)), np.cumsum(spans) - spans if name == "base32" else np.cumsum(lengths) - lengths
        counted: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in LENGTHS:
            rows = lengths // n
            if not rows.any():
                continue
            before = np.cumsum(rows) - rows
            starts = np.repeat(begins - n * before, rows) + n * np.arange(rows.sum())
            if n // 2 in counted and n % 2 == 0:  # a text's rows of half the length, two by two
                counts, half = counted[n // 2]
                squares, counts = doubled(counts, np.repeat(half - 2 * before, rows) + 2 * np.arange(rows.sum()))
            else:
                squares, counts = squared(x, starts, n, k, keep=2 * n in LENGTHS)
            if 2 * n in LENGTHS:
                counted[n] = counts, before
            total, square, product, up, changes = short_sums(upto, starts, n)
            yield STRATA.index((name, n)), fisher(_uniform(n, k)[squares], _alternating(n)[up * n + changes], total, square, product, x[starts] + x[starts + n - 1], n)


def grouped(texts: Iterable[bytes]) -> Iterator[list[bytes]]:
    """Texts in lists of ``BLOCK`` bytes or one text more."""
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size >= BLOCK:
            yield group
            group, size = [], 0
    if group:
        yield group


def candidates(texts: list[str]) -> tuple[list[list[tuple[int, int, int]]], dict[int, np.ndarray]]:
    """For each text its candidates (start, end, number), and for each stratum the candidates' numbers and bins."""
    placed: list[list[tuple[int, int, int]]] = []
    alike: dict[tuple[str, int], list[tuple[int, bytes]]] = {}
    number = 0
    for t in texts:
        here = []
        for m in CANDIDATE.finditer(t):
            known = encoding(m[0].encode())
            if known is None or len(known[1]) < LENGTHS[0]:
                continue
            here.append((m.start(), m.end(), number))
            alike.setdefault((known[0], len(known[1])), []).append((number, known[1]))
            number += 1
        placed.append(here)
    out: dict[int, list[np.ndarray]] = {}
    for (name, n), members in alike.items():
        step = max(1, SYMBOLS // n)
        for a in range(0, len(members), step):
            some = members[a : a + step]
            codes = _CODES[name][np.frombuffer(b"".join(x for _, x in some), np.uint8).reshape(len(some), n)]
            out.setdefault(stratum(name, n), []).append(np.stack([np.array([i for i, _ in some]), bins(battery(codes, len(ALPHABETS[name])))], axis=1))
    return placed, {s: np.concatenate(x) for s, x in out.items()}


def counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``stratum, side, bin, n`` of a task's texts; side 0: ordinary text, 1: candidates."""
    counts = np.zeros((len(STRATA), 2, BINS + 1), np.int64)
    for batch in slices(batches, "text", PIECE):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        for group in grouped(t.encode() for t in texts):
            for s, sums in ordinary(group):
                counts[s, 0] += np.bincount(bins(sums), minlength=BINS + 1)
        for s, found in candidates(texts)[1].items():
            counts[s, 1] += np.bincount(found[:, 1], minlength=BINS + 1)
    at = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (*at, counts[at])], names=["stratum", "side", "bin", "n"])


def thresholds(counts: np.ndarray, rate: float = RATE) -> np.ndarray:
    """The last bin of each stratum that is a discovery (-1: none), by Benjamini and Hochberg's rule on shares of ordinary text."""
    out = np.full(len(counts), -1)
    for s, (plain, found) in enumerate(counts):
        p = (1 + np.cumsum(plain)) / (1 + plain.sum())
        kept = np.cumsum(found)
        good = np.flatnonzero((kept > 0) & (p * max(1, found.sum()) <= rate * kept) & (np.arange(BINS + 1) < MOST * STEPS))
        if len(good):
            out[s] = good[-1]
    return out


def known(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the known forms, leftmost and non-overlapping for each kind."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def outside(found: list[tuple[int, int, int]], spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Those of ``found`` (sorted, disjoint) that don't lie inside a span: the furthest end of all spans that start before tells."""
    out, i, reach = [], 0, 0
    for f in found:
        while i < len(spans) and spans[i][0] <= f[0]:
            reach = max(reach, spans[i][2])
            i += 1
        if f[2] > reach:
            out.append(f)
    return out


SCHEMA = "n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"


def scan(docs: DataFrame, *, key: str = "doc_id", text: str = "text", rate: float = RATE) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans`` for every row of ``docs``, which is read twice and not shuffled.

    The first reading counts the battery's sums (at most 24,000 counters,
    whatever the input), the second writes the spans. ``random`` spans lie in
    no known one. Null and empty texts have no spans; ids are passed on as
    they are, null and repeated ones too, and repeated rows are counted as
    often as they stand; other columns are ignored. An empty table gives no rows.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    counted = rows.select("text").mapInArrow(counting, "stratum long, side long, bin long, n long").groupBy("stratum", "side", "bin").agg(F.sum("n").alias("n"))
    counts = np.zeros((len(STRATA), 2, BINS + 1), np.int64)
    for r in counted.collect():  # bounded by STRATA and BINS
        counts[r["stratum"], r["side"], r["bin"]] = r["n"]
    last = thresholds(counts, rate)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            placed, tested = candidates(texts)
            random = {int(i) for s, found in tested.items() for i in found[found[:, 1] <= last[s], 0]}
            out = []
            for t, here in zip(texts, placed):
                base = known(t)
                more = outside([(a, 3, b) for a, b, i in here if i in random], base)
                n = [sum(kind == k for _, kind, _ in base) for k in range(3)]
                out.append((*n, len(more), hashlib.sha256(told(base).encode()).hexdigest(), told(sorted(base + more))))
            columns = [pa.array([x[i] for x in out], pa.int64() if i < 4 else pa.string()) for i in range(6)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *(f.split()[0] for f in SCHEMA.split(", "))])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {SCHEMA}")
