"""The battery's shared sums and doubled counts against plain counting, row by row; and the work that a letter takes."""

import base64
import cProfile
import pstats

import numpy as np

from moraine.llm import secret_scan
from moraine.llm.secret_scan import ALPHABETS, LENGTHS, STRATA

WORDS = [b"lorem", b"Ipsum", b"dolor", b"sit", b"AMET", b"zebra"]


def made(rng, n):
    return b" ".join(WORDS[i] for i in rng.integers(0, len(WORDS), n))


def plain_rows(text, name, n):
    letters = bytes(b for b in text if chr(b).isascii() and chr(b).isalpha())
    if name == "hex":
        symbols = letters.hex().encode()
    elif name in ("base32", "base64"):
        symbols = (base64.b32encode if name == "base32" else base64.b64encode)(letters).rstrip(b"=")
    else:
        symbols = letters.lower() if name == "base36" else letters
    codes = [ALPHABETS[name].index(b) for b in symbols]
    return [codes[a : a + n] for a in range(0, len(codes) - n + 1, n)]


def test_ordinary_rows_are_tested_as_single_rows_are():
    rng = np.random.default_rng(5)
    texts = [made(rng, n) for n in (1, 4, 5, 9, 30, 77, 200)] + [b"", b"q" * 300, b"aZ" * 65, b"12 34"]
    got = dict(secret_scan.ordinary(texts))
    for s, (name, n) in enumerate(STRATA):
        rows = [r for t in texts for r in plain_rows(t, name, n)]
        assert (got[s] == secret_scan.battery(np.array(rows, np.int64), len(ALPHABETS[name]))).all()
        assert len(got[s]) == len(rows)


def test_symbols_are_counted_for_three_of_six_lengths_only():
    text = made(np.random.default_rng(6), 20_000)
    profile = cProfile.Profile()
    profile.enable()
    rows = sum(len(sums) for _, sums in secret_scan.ordinary([text]))
    profile.disable()
    calls = {name: n for (_, _, name), (_, n, *_) in pstats.Stats(profile).stats.items()}
    assert rows > 0
    assert calls["squared"] == len(ALPHABETS) * len({n for n in LENGTHS if n // 2 not in LENGTHS or n % 2})
    assert "_b32encode" not in calls
