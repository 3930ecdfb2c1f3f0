import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from moraine.llm import hard_negatives, secret_scan, spelling_variants

# 11

def base_spans(text):
    """Character by character, without the operator's patterns."""
    out, word = [], "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    i = 0
    while i < len(text):
        name = next((k for k in ("password", "passwd", "secret", "token", "api_key", "apikey") if lowered.startswith(k, i)), None)
        if name:
            j = i + len(name)
            j += text[j : j + 1] in ("'", '"') and j < len(text)
            while text[j : j + 1] == " ":
                j += 1
            if text[j : j + 1] in (":", "=") and j < len(text):
                j += 1
                while text[j : j + 1] == " ":
                    j += 1
                j += text[j : j + 1] in ("'", '"') and j < len(text)
                e = j
                while e < len(text) and text[e] in word + "+/_.=-":
                    e += 1
                if e > j:
                    if e - j >= 6:
                        out.append((i, 0, e))
                    i = e
                    continue
        i += 1
    for kind, start, letters, least in ((1, "AKIA", word[:26] + word[52:], 20), (2, "", "0123456789abcdef", 24)):
        i = 0
        while i < len(text):
            if text.startswith(start, i):
                e = i + len(start)
                while e < len(text) and text[e] in letters:
                    e += 1
                if e > i + len(start):
                    if e - i >= least:
                        out.append((i, kind, e))
                    i = e
                    continue
            i += 1
    return sorted(out)


def test_known_secrets_by_brute_force():
    rng = random.Random(1)
    parts = ["password", "Passwd", "SECRET", "token", "api_key", "ApiKey", "api__key", '"', "'", " ", "  ", ":", "=", "abc", "hunter22", "AKIA", "AKIA" + "Q2" * 8, "deadbeef", "0f" * 12, "é", "ſecret=longenough", "toKen=abcdef", "-", "\n", "x.y/z+"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert secret_scan.known(text) == base_spans(text), text


def test_the_battery_is_calibrated_and_tells_text():
    rng = np.random.default_rng(2)
    for k in (16, 32, 64):
        for n in (20, 40, 128):
            sums = secret_scan.battery(rng.integers(0, k, (4000, n)), k)
            assert (sums > secret_scan.MOST).mean() < 0.006  # a uniform token is hardly ever rejected at 1e-4
            assert 0.4 < (sums > 5.35).mean() < 0.65  # the median of chi-squared with six degrees
    text = "therewerenoothersintheeveningsothestoneswerestillthereintheriverlater"
    codes = secret_scan._CODES["base36"][np.frombuffer(text[:64].encode(), np.uint8)][None]
    assert secret_scan.battery(codes, 36)[0] > 40
    assert secret_scan.battery(np.zeros((1, 40), int), 16)[0] > 200 and secret_scan.battery(np.arange(40)[None] % 2 * 15, 16)[0] > 60


def test_statistics_by_plain_loops():
    rng = random.Random(3)
    for k, n in ((16, 24), (62, 33)):
        row = [rng.randrange(k) for _ in range(n)]
        chi = sum((row.count(s) - n / k) ** 2 / (n / k) for s in range(k))
        mean, df = k - 1, (k - 1) * n / (n - 1)
        z = ((chi / mean) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
        above = [s >= k / 2 for s in row]
        up, down = sum(above), n - sum(above)
        runs = 1 + sum(a != b for a, b in zip(above, above[1:]))
        mu = 1 + 2 * up * down / n
        zr = (runs - mu) / math.sqrt((mu - 1) * (mu - 2) / (n - 1))
        m = sum(row) / n
        r = sum((a - m) * (b - m) for a, b in zip(row, row[1:])) / sum((a - m) ** 2 for a in row)
        tail = lambda x: -math.log(math.erfc(x / math.sqrt(2)) / 2)
        expected = 2 * (tail(z) + max(0, tail(abs(zr)) - math.log(2)) + max(0, tail(abs(r + 1 / n) * math.sqrt(n)) - math.log(2)))
        assert secret_scan.battery(np.array([row]), k)[0] == pytest.approx(expected, rel=1e-3, abs=1e-3)


@pytest.mark.parametrize("token, name", [("deadbeef00", "hex"), ("DEADBEEF00", "hex"), ("XYZ234", "base32"), ("XYZ189", "base36"), ("abcz09", "base36"), ("aBcz09", "base62"), ("aB+z/9==", "base64"), ("aB-z_9", "base64"), ("a+b_c", None), ("1234567890", None)])
def test_encodings(token, name):
    found = secret_scan.encoding(token.encode())
    assert (found and found[0]) == name


def test_thresholds_by_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(20):
        plain, found = rng.integers(0, 30, (2, secret_scan.BINS + 1)) * (rng.random((2, secret_scan.BINS + 1)) < 0.1)
        plain[: rng.integers(1, 90)] = 0
        last = secret_scan.thresholds(np.array([[plain * 50, found]]), 0.1)[0]
        best = -1
        for b in range(secret_scan.BINS + 1):
            k, m = found[: b + 1].sum(), found.sum()
            if k and b < secret_scan.MOST * secret_scan.STEPS and (1 + 50 * plain[: b + 1].sum()) / (1 + 50 * plain.sum()) * m <= 0.1 * k:
                best = b
        assert last == best


def test_every_text_speaks_for_every_stratum(monkeypatch):
    monkeypatch.setattr(secret_scan, "BLOCK", 28_800)
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("aBcdEfg hij 12."), size)) for size in (10, 200, 3_000, 90_000)]
    table = next(secret_scan.counting(iter([pa.RecordBatch.from_pydict({"text": [None, *texts]})])))
    got = {(s, b): n for s, side, b, n in zip(*(c.to_pylist() for c in table.columns)) if side == 0}
    expected = Counter()
    for s, (name, n) in enumerate(secret_scan.STRATA):
        for t in texts:
            letters = "".join(c for c in t if c.isalpha()).encode()
            written = {"hex": letters.hex().encode(), "base32": base64.b32encode(letters).rstrip(b"="), "base36": letters.lower(), "base62": letters, "base64": base64.b64encode(letters).rstrip(b"=")}[name]
            codes = secret_scan._CODES[name][np.frombuffer(written, np.uint8)]
            rows = codes[: len(codes) // n * n].reshape(-1, n)
            expected.update((s, int(b)) for b in secret_scan.bins(secret_scan.battery(rows, len(secret_scan.ALPHABETS[name]))))
    assert got == expected and {s for s, _ in got} == set(range(len(secret_scan.STRATA)))


def secret_documents(spark, copies=1):
    rng = random.Random(5)
    prose = [" ".join(rng.choice(["river", "stone", "walking", "evening", "about", "light", "some", "other", "there", "never"]) for _ in range(400)) for _ in range(150)]
    b64 = [base64.b64encode(rng.randbytes(48)).decode() for _ in range(30)]
    texts = [p + " " + b64[i] + " tail" if i < 30 else p for i, p in enumerate(prose)]
    plain = ["/".join(["evening", "walking", "Stone", "river"] * 4), "a" * 80, "ThereNeverSomeOtherLightAbout" * 3, "acgt" * 300]
    texts += plain + [None, "", "token='abcdefgh' " + "0123456789abcdef" * 2 + " AKIA" + "7" * 16]
    return spark.createDataFrame([(i, t, "en", 1) for i, t in enumerate(texts * copies)], "doc_id long, text string, n_hex string, text_ int"), b64, len(texts)


def test_random_tokens_are_found_and_text_is_left(spark):
    docs, b64, n = secret_documents(spark)
    rows = {r["doc_id"]: r for r in secret_scan.scan(docs.repartition(5)).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert len(rows) == n
    for i, r in rows.items():
        base = base_spans(texts[i])
        said = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == x for _, k, _ in base) for x in range(3)]
        spans = r["spans"].split(",") if r["spans"] else []
        assert [s for s in spans if not s.startswith("random")] == (said.split(",") if said else [])
        for s in spans:
            if s.startswith("random"):
                _, a, b = s.split(":")
                assert texts[i][int(a) : int(b)] in b64
    assert sum(rows[i]["n_random"] for i in range(30)) >= 28 and sum(r["n_random"] for r in rows.values()) == sum(rows[i]["n_random"] for i in range(30))
    assert (rows[n - 1]["n_assign"], rows[n - 1]["n_access"], rows[n - 1]["n_hex"]) == (1, 1, 1)
    assert rows[n - 3]["spans"] == rows[n - 2]["spans"] == ""


def test_secret_rows(spark):
    docs, _, n = secret_documents(spark, copies=2)
    odd = docs.union(spark.createDataFrame([(None, "secret: 1234567", "x", 1), (None, "secret: 1234567", "x", 1), (7, "ab12" * 100_000, "x", 1), (8, "/z" * 200_000 + " token", "x", 1)], docs.schema))
    assert secret_scan.scan(odd).count() == 2 * n + 4
    assert [r["spans"] for r in secret_scan.scan(odd).filter("doc_id is null").collect()] == ["assign:0:15"] * 2
    assert secret_scan.scan(docs.limit(0)).collect() == []
    assert secret_scan.scan(docs.limit(0)).columns == ["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"]


# 12

def mined(rows):
    good = [(u, i, (l + 1) % 10 if i is not None and i % 7 == 0 else l, [math.floor(256 * x) for x in v]) for u, (i, v, l) in enumerate(rows) if l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = lambda r: (-r[0], r[1] is None, r[1] if r[1] is not None else 0)
    out = Counter()
    for u, i, l, v in good:
        if i is None or i % 50:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, m) for x, j, m, w in good if x != u and len(w) == len(v)]
        for p, pid, _ in sorted([s for s in scored if s[2] == l], key=order)[:5]:
            fits = sorted([s for s in scored if s[2] != l and 50 * p <= 100 * s[0] <= 95 * p], key=order)[:3]
            out.update((i, pid, k, j, p, s) for k, (s, j, _) in enumerate(fits, 1))
    return out


VECTORS = "vec_id long, embedding array<double>, label int, id string, score int"


@pytest.mark.parametrize("seed, anchors, first", [(0, 3000, 8), (1, 2, 8), (2, 3000, 1)])
def test_hard_negatives_by_brute_force(spark, monkeypatch, seed, anchors, first):
    rng = random.Random(seed)
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)
    monkeypatch.setattr(hard_negatives, "FIRST", first)
    monkeypatch.setattr(hard_negatives, "ROWS", 16)
    hot = [0.5, 0.25, -0.5]
    rows = [(rng.choice([i, i, i, None]), hot if rng.random() < 0.3 else [rng.choice([0.0, 0.01, rng.gauss(0, 1)]) for _ in range(rng.choice([3, 3, 3, 2, 0]))], rng.choice([0, 1, 2, 9, None])) for i in range(0, 400)]
    rows += [rows[0], rows[50], rows[100], (150, None, 1), (200, [1.0, None, 0.0], 1), (250, [float("nan")] * 3, 1), (300, [float("inf"), 0.0, 0.0], 1), (350, [0.0] * 3, 1), (-50, [1.0, 2.0, 3.0], -1)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], VECTORS).repartition(4)
    found = Counter(map(tuple, hard_negatives.mine(df).collect()))
    assert found == mined(rows)


def test_hard_negatives_beyond_double_precision(spark):
    rows = [(i, [4e5 + i, 3.7e5 + 2 * i, 1.0], i % 2) for i in range(60)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], VECTORS)
    assert Counter(map(tuple, hard_negatives.mine(df).collect())) == mined(rows)
    assert hard_negatives.products(np.array([[2.0**30, 1.0]]), np.array([[2.0**30, 1.0]]))[0, 0] == 2**60 + 1
    with pytest.raises(OverflowError):
        hard_negatives.products(np.array([[2.0**40]]), np.array([[2.0**40]]))


def test_hard_negatives_of_nothing(spark):
    none = spark.createDataFrame([], VECTORS)
    assert hard_negatives.mine(none).collect() == []
    assert hard_negatives.mine(spark.createDataFrame([(1, [1.0], 0, "x", 1)], VECTORS)).columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_buckets_out_of_reach_are_not_scored(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(0)
    n = 400
    vectors = rng.normal(size=(n, 4)) * np.linspace(8, 0.01, n)[:, None]
    whole = np.floor(256 * vectors)
    norms = np.sqrt((whole**2).sum(axis=1))
    order = np.argsort(-norms)
    batch = pa.RecordBatch.from_arrays([pa.array(order), pa.array(order), pa.array(np.zeros(n, np.int64)), pa.array(norms[order]), pa.array(vectors[order].tolist())], names=["id", "uid", "label", "norm", "v"])
    block = hard_negatives.Block(order[:2], order[:2], np.zeros(2, np.int64), norms[order[:2]], {4: (np.arange(2), whole[order[:2]])})
    shape = (1, 2)
    seen = []
    monkeypatch.setattr(hard_negatives, "ROWS", 20)
    monkeypatch.setattr(hard_negatives, "products", lambda a, b, f=hard_negatives.products: seen.append(len(b)) or f(a, b))
    want = hard_negatives.Need(5, True, np.full(shape, hard_negatives.LOWEST), np.full(shape, hard_negatives.HIGHEST), np.zeros(shape, bool), np.zeros(shape, np.int64))
    rows = [np.array(x.column("score")) for x in hard_negatives.searching(block, want)(iter([batch]))]
    assert sum(seen) < n // 2 and len(rows[0]) == 10


# 13

def spelt(docs, shortest=5, least=3, modulus=97):
    counts = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % modulus == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    forms, out = {}, {}
    for w, n in words.items():
        others = [v for v in words if v != w and near(w, v)]
        top = min(others, key=lambda v: (-words[v], v), default=None)
        forms[w] = top if top is not None and words[top] >= 2 * n else None
        out[w] = (len(others), n)
    rows = set()
    for w, (k, n) in out.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        rows.add((w, forms[w], root, n, k, words[forms[w]] if forms[w] is not None else None))
    return rows


def letters_documents(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n int").repartition(3)


@pytest.mark.parametrize("seed, alphabet, modulus", [(0, "abc", 5), (1, "aé", 7), (2, "abcdefgh", 97), (3, "a", 3)])
def test_spelling_by_brute_force(spark, seed, alphabet, modulus):
    rng = random.Random(seed)
    pool = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 9))) for _ in range(150)]
    rows = [(rng.choice([i, None, i // 2]), rng.choice([" ", "1", "×", "_"]).join(rng.choice(pool).upper() if rng.random() < 0.2 else rng.choice(pool[: rng.choice([10, 150])]) for _ in range(60))) for i in range(40)]
    rows += [(None, None), (5, ""), rows[3], rows[3]]
    found = spelling_variants.variants(letters_documents(spark, rows), modulus=modulus)
    expected = spelt(rows, modulus=modulus)
    assert Counter(map(tuple, found.select("word", "form", "root", "n", "n_near", "form_n").collect())) == Counter(expected) and expected


def test_spelling_of_long_texts_and_nothing(spark):
    long = "ab" * 20_000
    rows = [(1, f"{long} {long}x {long}"), (2, f"{long}x {long}x, {long}"), (3, "Straße straße STRAßE strase strase strase strase strase strase")]
    assert Counter(map(tuple, spelling_variants.variants(letters_documents(spark, rows)).select("word", "form", "root", "n", "n_near", "form_n").collect())) == Counter(spelt(rows))
    assert spelling_variants.variants(letters_documents(spark, rows).limit(0)).collect() == []
    assert spelling_variants.variants(letters_documents(spark, [(1, "one two")])).collect() == []
    with pytest.raises(ValueError):
        spelling_variants.variants(letters_documents(spark, rows), shortest=3)


def test_chains_of_forms_lead_to_the_last(spark):
    words = ["abcdefgh", "bbcdefgh", "bccdefgh", "bcddefgh", "bcdeefgh", "bcdeffgh"]
    rows = [(i, " ".join([w] * (3 * 2**k))) for i, (k, w) in enumerate(enumerate(words))]
    found = {r["word"]: r["root"] for r in spelling_variants.variants(letters_documents(spark, rows), modulus=10**9).collect()}
    assert found == {w: words[-1] for w in words}
