import random
import time

import duckdb
import pytest

from moraine.llm import decontaminate, html_extract, license_scan, oracle
from moraine.llm.sentencepiece_lattice import pieces


def merged_plainly(table, symbols):
    """The rule as it is told: again and again the best pair of neighbours, the leftmost of equals."""
    s = list(symbols)
    while True:
        ranks = [(table.rank[a + b], i) for i, (a, b) in enumerate(zip(s, s[1:])) if a + b in table.rank]
        if not ranks:
            return s
        _, i = min(ranks)
        s[i : i + 2] = [s[i] + s[i + 1]]


def test_merges_by_brute_force():
    table, rng = pieces(), random.Random(0)
    for letters in ("acgt", "aab", "thereandtion", "abcdefghijklmnopqrstuvwxyz"):
        for _ in range(60):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 120)))
            assert table.merged(list(text)) == merged_plainly(table, text)


def test_an_unbroken_run_of_a_million_letters():
    table, rng = pieces(), random.Random(1)
    for text in ("".join(rng.choice("acgt") for _ in range(1_000_000)), "a" * 1_000_000):
        began = time.perf_counter()
        ids = table.part(text)
        assert time.perf_counter() - began < 30  # some 3 s, on an idle machine
        assert b"".join(table.table[i] for i in ids).decode() == text


def test_twenty_thousand_copies_of_a_licence():
    s = license_scan.scanner()
    began = time.perf_counter()
    n, n_base, first, last, base, labels, score, spans = s.scan("Released under the MIT License. " * 20_000)
    assert time.perf_counter() - began < 30  # some 2 s, on an idle machine
    assert (n, n_base, first, last, base, score) == (100_000, 20_000, 3, 99_998, {"mit"}, 1.0)
    assert [x for x in spans if x[2] == "mit"] == [(5 * k, 5 * k + 5, "mit") for k in range(20_000)]


def test_chains_by_brute_force():
    """The best of all chains of matches, in texts that a chain may span as a whole."""
    from itertools import combinations

    template = "a b c d e f g h i j k l".split()
    s = license_scan.scanner({"x": [" ".join(template)]}, {}, least=2, share=0.6)
    rng = random.Random(3)
    for _ in range(150):
        words = []
        while len(words) < 18:
            at = rng.randrange(len(template) - 2)
            words += template[at : at + rng.randint(2, 5)] if rng.random() < 0.6 else ["z"] * rng.randint(1, 4)
        coded = [w.encode() for w in words]
        found = [(b, b + n) for b in range(len(words)) for n in range(2, 6) if b + n <= len(words) and any(template[a : a + n] == words[b : b + n] for a in range(len(template))) and rng.random() < 0.25][:9]
        best, spans = s._chains(coded, 0, found)
        places = [(b, e, a) for b, e in found for a in range(len(template)) if template[a : a + e - b] == words[b:e]]
        expected = 0
        for k in range(1, 7):
            for chain in combinations(sorted(places), k):
                if all(x[1] <= y[0] and x[2] + x[1] - x[0] <= y[2] for x, y in zip(chain, chain[1:])):
                    expected = max(expected, sum(e - b for b, e, _ in chain))
        assert best * len(template) == pytest.approx(expected)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


CASES = ['<section id="discussion">{}</section>', '<section id="search">{}</section>', '<div class="lead related">{}</div>', '<div class="share">{}</div>', '<figure class="share">{}</figure>', '<blockquote class="comment">{}</blockquote>', '<div class="menu">{}</div>', '<p class="skip">{}</p>']


@pytest.mark.parametrize("case", CASES)
def test_names_alone_take_nothing_out_of_an_article(case):
    page = f"<body><nav>top</nav><div class='sidebar'>side</div><article><h1>Title</h1><p>one</p>{case.replace('{}', 'kept words')}<div class='ad'>buy</div><div class='comments'>nice</div><p>two</p></article><footer>end</footer></body>"
    assert html_extract.extract([page]) == ["Title one kept words two"]


def test_null_items_are_found_as_the_sql_has_it(spark):
    rng = random.Random(6)
    words = "a b c d e f".split()
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(k if k % 3 else None, say(rng.choice([2, 3, 13, 20]))) for k in range(12)] + [(None, None), (None, ""), (5, "one")]
    docs = [(k, say(rng.choice([0, 1, 5, 60, 200]))) for k in range(40)] + [(77, None), (78, "one two three")]
    bench, rows = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    db = duckdb.connect()
    for name, kind, values in (("benchmark", "item_id BIGINT", items), ("documents", "doc_id BIGINT", docs)):
        db.execute(f"CREATE TABLE {name} ({kind}, text VARCHAR)")
        db.executemany(f"INSERT INTO {name} VALUES (?, ?)", values)
    for block in (decontaminate.BLOCK, 20):
        found = decontaminate.decontaminate(rows, bench, block=block)
        assert sorted(map(tuple, found.collect())) == sorted(db.execute(f"SELECT {', '.join(found.columns)} FROM ({oracle.OP8})").fetchall())
