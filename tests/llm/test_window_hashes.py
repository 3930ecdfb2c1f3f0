import numpy as np
import pyarrow as pa
import pytest

from moraine.llm import substring_dedup

PHRASE = [f"p{i}" for i in range(12)]
#: Two documents with one phrase in different contexts, and a repeated one.
DIFFERENT = [[f"{c}{i}" for i in range(11)] + PHRASE + [f"{c}{i}" for i in range(20, 31)] for c in "ab"]


def spans(pieces):
    """Spans of documents (id, words) that come in pieces, as one bucket."""
    made = [substring_dedup._piece(pa.RecordBatch.from_arrays([pa.array([i for i, _ in p]), pa.array([" ".join(w) for _, w in p])], names=["doc_id", "text"]), 20, 1) for p in pieces]
    return sorted(tuple(r) for r in substring_dedup._meet(pa.Table.from_batches(made).to_pandas(), 20).itertuples(index=False))


def test_windows_that_differ_in_low_bits_only_are_told_apart(monkeypatch):
    real = substring_dedup.grams
    monkeypatch.setattr(substring_dedup, "grams", lambda h, k: real(h, k) & np.uint64(0xFFFFFF))
    a, b = enumerate(DIFFERENT)
    assert spans([[a], [b]]) == [] == spans([[a, b]])
    assert spans([[a, b], [(2, DIFFERENT[0])]]) == [(2, 0, len(DIFFERENT[0]))]


@pytest.mark.parametrize("words", [DIFFERENT + DIFFERENT[:1], [[f"w{(i * i + d) % 23}" for i in range(60)] for d in range(6)]])
def test_results_do_not_depend_on_pieces(monkeypatch, words):
    covered = lambda found: {(d, i) for d, a, b in found for i in range(a, b)}
    real = substring_dedup.grams
    for mask in (0xFFFFFF, 2**64 - 1):
        monkeypatch.setattr(substring_dedup, "grams", lambda h, k: real(h, k) & np.uint64(mask))
        rows = list(enumerate(words))
        assert covered(spans([rows])) == covered(spans([[r] for r in rows])) == covered(spans([rows[:2], rows[2:]]))
