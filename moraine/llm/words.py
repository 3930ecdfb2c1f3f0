"""Words of whole texts as numpy arrays, read straight from Arrow buffers.

Two definitions of a word are used by the operators:

* ``SPACED``: ``[^\\x20\\x09-\\x0D]+`` (whatever stands between ASCII white space);
* ``ALNUM``: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.

Both can be decided byte by byte, because every byte of a non-ASCII character
is above 0x7F and never a separator.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute

_LIBC = ctypes.CDLL(None)
_BYTES = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_SPACE = (_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D))
_LETTER = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 0x80)

#: bytes.translate table after which ``split()`` gives the ALNUM words.
ALNUM_TABLE = bytes(int(_LOWER[b]) if _LETTER[_LOWER[b]] else 32 for b in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bytes of text whose words are hashed at a time.
BLOCK = 250_000

_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_POWERS = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        steps = np.full(max(n, 64), 0xD6E8FEB86659FD93, dtype=np.uint64)
        steps[0] = 1
        _POWERS = np.cumprod(steps, dtype=np.uint64)
    return _POWERS


@dataclass
class Words:
    """``hash``, ``start`` and ``end`` (byte offsets) per word; ``doc``: its row; ``first``: rows' first words."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    buffer: np.ndarray
    offsets: np.ndarray


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts (null: empty) and each text's offsets in them."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(texts: pa.Array, *, lower: bool = False, alnum: bool = False) -> Words:
    """Words of all texts. ``alnum`` takes ALNUM words (and lower-cases), else SPACED ones."""
    buffer, offsets = buffers(texts)
    if lower or alnum:
        buffer = _LOWER[buffer]
    inside = (_LETTER if alnum else ~_SPACE)[buffer]
    n = len(buffer)
    rows = len(offsets) - 1
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(none.astype(np.uint64), none, none, none, np.zeros(rows + 1, np.int64), buffer, offsets)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < n]
    begins[cuts] = inside[cuts]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = cuts[cuts > 0] - 1
    ends[last] = inside[last]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(rows), np.diff(first))
    if len(start) == 0:
        return Words(start.astype(np.uint64), start, end, doc, first, buffer, offsets)
    length = end - start
    powers = _powers(int(length.max()) + 1)
    total = np.empty(len(start), np.uint64)
    a = 0
    while a < len(start):  # some words at a time: each of their bytes takes some 40 in between
        b = max(a + 1, int(np.searchsorted(start, start[a] + BLOCK)))
        where = np.flatnonzero(inside[start[a] : end[b - 1]]) + start[a]
        begin = np.cumsum(length[a:b]) - length[a:b]
        at = np.arange(len(where)) - np.repeat(begin, length[a:b])
        total[a:b] = np.add.reduceat(_TABLE[buffer[where]] * powers[at], begin)
        a = b
    return Words(mix(total + length.astype(np.uint64)), start, end, doc, first, buffer, offsets)


def give_back() -> None:
    """Returns freed memory to the system: a Python worker lives on after a task, and the executor's limit counts it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(_LIBC, "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``limit`` bytes of text, so that memory doesn't follow the batch."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column).cast(pa.large_binary())), 0))
        before = np.cumsum(sizes) - sizes
        piece = before // limit
        cuts = np.flatnonzero(np.diff(piece)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield batch.slice(a, b - a)
        give_back()


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of ``k`` consecutive words, ``len - k + 1`` values."""
    if len(hashes) < k:
        return np.zeros(0, np.uint64)
    power, span, out, have = hashes, 1, None, 0
    left = k
    while True:
        if left & 1:
            if out is None:
                out, have = power, span
            else:
                m = min(len(out), len(power) - have)
                out, have = mix(out[:m] * np.uint64(0xA0761D6478BD642F) + power[have : have + m]), have + span
        left >>= 1
        if not left:
            break
        m = len(power) - span
        power, span = mix(power[:m] * np.uint64(0xE7037ED1A0B428DB) + power[span : span + m]), span * 2
    return out[: len(hashes) - k + 1]
