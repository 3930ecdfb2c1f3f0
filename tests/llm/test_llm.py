import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from moraine.llm import ann, decontaminate, html_extract, license_scan, near_dedup, oracle, packing, queries, sentencepiece_lattice, sharding, substring_dedup, toxicity
from moraine.llm.components import components
from moraine.llm.words import grams, words

SF = "/root/testdata/sf0.001"
LONG = "word " * 30_000
TEXTS = [None, "", " ", "one", "a b c d e f", "A b C d E f", "a b c d e f", "é日本 🙂 x", "  two  spaces\n\tand tabs ", LONG, LONG + "end"]


def documents(spark, texts=TEXTS, ids=None):
    ids = ids or list(range(len(texts)))
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 7) for i, t in zip(ids, texts)], "doc_id long, text string, lang string, source string, n_chars long, shard int")


def spaced(text, lower=False):
    t = text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t) if lower else t)


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


@pytest.mark.parametrize("kind", [dict(), dict(lower=True), dict(alnum=True)])
def test_words_are_the_pattern_s(kind):
    w = words(pa.array(TEXTS + ["x", "x"]), **kind)
    found = [bytes(w.buffer[a:b]).decode() for a, b in zip(w.start, w.end)]
    expected = [(alnum(t) if kind.get("alnum") else spaced(t, kind.get("lower", False))) for t in TEXTS + ["x", "x"]]
    assert found == [x for e in expected for x in e]
    assert np.diff(w.first).tolist() == [len(e) for e in expected]
    assert len(set(zip(found, w.hash.tolist()))) == len(set(found)) == len(set(w.hash.tolist()))


def test_grams_tell_sequences_apart():
    h = words(pa.array(["a b a b a b c a b"])).hash
    for k in (1, 2, 3, 5, 8):
        seqs = [tuple(h[i : i + k]) for i in range(len(h) - k + 1)]
        g = grams(h, k).tolist()
        assert len(g) == len(seqs) and len(set(zip(seqs, g))) == len(set(seqs)) == len(set(g))


# 1

def test_sharding(spark):
    docs = documents(spark, [f"t{i % 50}" if i % 9 else None for i in range(3000)]).union(documents(spark, ["x", "x"], [None, 5]))
    rows = sharding.assign(docs).collect()
    assert len(rows) == 3002
    for s in range(16):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    counts = [sum(r["shard"] == s for r in rows) for s in range(16)]
    assert min(counts) > 120 and max(counts) < 260
    assert all(r["grown_shard"] in (r["shard"], 16) for r in rows) and any(r["grown_shard"] == 16 for r in rows)
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] != 5}
    text = {i: f"t{i % 50}" if i % 9 else None for i in range(3000)}
    for i, t in text.items():
        if i != 5:
            assert (by_id[i]["size"], by_id[i]["text_crc32"]) == (len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
    assert sharding.assign(docs.limit(0)).count() == 0


def test_weights_move_rows_only_into_what_grew(spark):
    keys = spark.range(4000).select(F.col("id").alias("k"))
    old = sharding.grid(16)
    new = [sharding.Shard(s.region, s.rack, s.shard, 3.0 if s.shard == 5 else 1.0) for s in old]
    moved = keys.select(sharding.descend(F.col("k"), old).alias("a"), sharding.descend(F.col("k"), new).alias("b")).filter("a <> b").collect()
    assert moved and all(r["b"] // 8 == 0 for r in moved)  # into the subtree of shard 5 only
    share = keys.select(sharding.descend(F.col("k"), new).alias("b")).filter("b = 5").count() / 4000
    assert abs(share - 3 / 18) < 0.03
    with pytest.raises(ValueError):
        sharding.descend(F.col("k"), [])


# 2

def test_license_places_by_brute_force():
    s = license_scan.scanner()
    rng = random.Random(5)
    vocabulary = ["MIT", "license", "apache", "general", "public", "gnu", "under", "the", "x"]
    for _ in range(500):
        text = rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(rng.randrange(40)))
        w = alnum(text)
        places = [(i, label) for p, label in license_scan.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        n, n_base, first, last, base, labels, score, _ = s.scan(text)
        assert (n, n_base) == (len(w), len(places)) and base == {x for _, x in places} and base <= labels and 0 <= score <= 1
        assert (first, last) == ((min(places)[0], max(places)[0]) if places else (None, None))


def test_matching_statistics_by_brute_force():
    s = license_scan.scanner({"a": ["x y z x y"], "b": ["y z q"]}, {"y z": "p"})
    rng = random.Random(2)
    templates = [license_scan.tokens(t) for t in ("x y z x y", "y z q", "y z")]
    pieces = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    for _ in range(300):
        w = [rng.choice([b"x", b"y", b"z", b"q", b"w"]) for _ in range(15)]
        got = {i: n for i, _, n in s.statistics(w)}
        for i in range(15):
            best = max((n for n in range(i + 2) if n == 0 or tuple(w[i + 1 - n : i + 1]) in pieces), default=0)
            assert got.get(i, 0) == best


def test_short_templates_need_their_words_and_every_copy_is_a_span():
    s = license_scan.scanner()
    for text in ("released under the", "Released under the Apache License", "Licensed under CC BY-ND 4.0", "Licensed under CC BY-NC-ND 4.0."):
        assert s.scan(text)[5] <= ({"apache"} if "Apache" in text else set()), text
    mit = license_scan.TEMPLATES["mit"][1]
    twice = s.scan(f"hereby granted free {mit} {'x ' * 300} {mit} end")
    n = len(license_scan.tokens(mit))
    assert [x[1] - x[0] for x in twice[7]] == [n, n] and twice[5] == {"mit"}


def test_license_rows(spark):
    docs = documents(spark, [*TEXTS, "Licensed under CC BY-NC 4.0.", "released UNDER the mit license!"])
    rows = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
    n = len(TEXTS)
    assert len(rows) == n + 2 and rows[0]["n_words"] == 0 and rows[0]["first_word"] is None and rows[0]["labels"] == ""
    assert (rows[n]["n_base"], rows[n]["labels"]) == (0, "cc-by-nc") and (rows[n + 1]["base_labels"], rows[n + 1]["first_word"]) == ("mit", 3)
    assert [tuple(s) for s in rows[n]["spans"]] == [(0, 7, "cc-by-nc")]
    assert license_scan.report(docs.limit(0)).count() == 0


# 3

def test_neighbours_by_brute_force(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((600, 8)).astype(np.float32)
    x[100:150] = x[0]  # copies of a query's vector
    vectors = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1001, [0.0] * 8), (1002, [float("nan")] * 8), (1003, [1.0] * 5), (None, [1.0] * 8), (1100, []), (7, x[7].tolist()), (1200, [None] * 8)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    got = {}
    for r in ann.search(df, leaf=32).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    assert sorted(got) == [0, 100, 200, 300, 400, 500]
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((x.astype(np.float64) - x[q].astype(np.float64)) ** 2).sum(axis=1))
        best = sorted((float(s), i) for i, s in enumerate(d) if i != q)[:10]
        assert found == sorted(found) and all(abs(s - d[i]) < 1e-12 for s, i in found)
        hits += len({i for _, i in best} & {i for _, i in found})
    assert hits / 60 >= 0.9
    assert [i for _, i in got[0]] == list(range(100, 110))  # ties to the smaller id
    assert ann.search(df.limit(0)).count() == 0 and ann.search(df.filter("vec_id >= 1000")).count() == 0
    few = ann.search(df.filter("vec_id in (100, 3, 4)"))
    assert few.count() == 2  # all candidates, if fewer


# 4

def test_main_text_of_marked_and_unmarked_pages():
    wrap = "<html><head><title>t</title><style>x{}</style></head><body><header>Site</header><nav><a href=x>Home</a></nav><div class='ad'>Buy</div>{}<aside>side</aside><form>f</form><div class='comments'><p>nice</p></div><footer>&copy;</footer><script>var a='<p>no</p>'</script></body></html>"
    pages = [wrap.replace("{}", f"<article><header><h1>Title {i}</h1></header><p>a&amp;b  <b>c</b>d<br>e{i}<p>second\n{i}<!-- gone --></article>") for i in range(6)]
    assert html_extract.extract(pages) == [f"Title {i} a&b cd e{i} second {i}" for i in range(6)]
    plain = ["<body><div class=top>My site</div><div class=story><p>Story %d<p>more %d</div><div>Always here</div></body>" % (i, i * i) for i in range(8)]
    assert html_extract.extract(plain) == [f"Story {i} more {i * i}" for i in range(8)]


def test_attributes_are_read_one_by_one():
    inside = ['<p style="overflow: hidden">a', '<p title="the hidden cost">b', '<p data-id="ad-7">c', '<p id="comment-policy">d', '<h2 id="discussion">e</h2>', "<div class='menu-du-jour no-sidebar'>f</div>", "<p data-x=1 class=lead>g"]
    for article in ("<article class='post search-results'>", "<div class='content has-sidebar'>"):
        page = f"<body><nav>menu</nav>{article}{''.join(inside)}<p class=ad>no<p hidden>no<div id='comments'>no</div>{'</article>' if 'article' in article else '</div>'}</body>"
        assert html_extract.extract([page]) == ["a b c d e f g"]


def test_the_template_finds_the_article_without_marks():
    rng = random.Random(8)
    say = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    pages, texts = [], []
    for _ in range(12):
        title, body, side = say(5), [say(30) for _ in range(rng.randrange(2, 6))], [say(2) for _ in range(4)]
        pages.append(f"<body><div class=x1><ul>{''.join(f'<li>{t}' for t in side)}</ul></div><div class=x2>{say(6)}</div><div class=x3><div class=x4><h1>{title}</h1>{''.join(f'<p>{t}' for t in body)}<p>Share this story</div></div><div class=x5>All rights reserved {say(1)}</div></body>")
        texts.append(" ".join([title, *body]))
    assert html_extract.extract(pages) == texts


def test_matching_looks_at_whole_trees():
    deep = lambda tag, n: f"<{tag}>" * n + "x" + f"</{tag}>" * n
    t = html_extract.Template(("#root", ""))
    html_extract.align(t, html_extract.parse(deep("div", 50)), {})
    assert html_extract._weight(t, html_extract.parse(deep("div", 50))) == 51 and html_extract._weight(t, html_extract.parse(deep("div", 7))) == 8
    wide = "".join(f"<div class=c{i}><b><i>x</i></b></div>" for i in range(60))
    t = html_extract.Template(("#root", ""))
    html_extract.align(t, html_extract.parse(wide), {})
    assert html_extract._weight(t, html_extract.parse(wide)) == 1 + 3 * 60


def test_html_cases(spark):
    pages = [(1, "http://a.b/x", None), (2, None, ""), (3, "http://a.b/y", "just text"), (3, "http://a.b/y", "just text"), (None, "nohost", "<p>x<p>y"), (4, "http://A.b/z", "<article>" + "<p>w</p>" * 3000 + "</article>"), (5, "http://a.b", "<div <p \"'<"), (6, "http://a.b/q", "<b>" * 3000 + "deep")]
    rows = html_extract.main_texts(spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit(1))).collect()
    got = sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in rows)
    assert [g for g in got if g[0] == 3] == [(3, "just text", 9)] * 2 and (0, "x y", 3) in got and (1, "", 0) in got and len(got) == 8
    assert next(r["text"] for r in rows if r["page_id"] == 4).split() == ["w"] * 3000
    assert html_extract.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pages_against_their_articles(spark):
    import html

    rows = queries.op4_html_extraction(spark, SF).join(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id").collect()
    for r in rows:
        inner = re.search(r"<article[^>]*>(.*?)</article>", r["html"], re.S)[1]
        assert r["text"] == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner))).split())


# 5

def test_toxicity_learns_words_and_stems():
    rng = random.Random(1)
    base = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(300)]

    def text(bad):
        w = [rng.choice(base) for _ in range(rng.randint(20, 90))]
        for _ in range(3 if bad else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["zzork", "quux", "wexl" + rng.choice(["a", "on", "ip", "est", "ur"])]))
        return " ".join(w)

    labels = [i % 4 == 0 for i in range(600)]
    p = toxicity.train([text(b) for b in labels], [int(b) for b in labels])
    new = [i % 3 == 0 for i in range(200)]
    scores = toxicity.score_texts(p, pa.array([text(b) for b in new]))
    assert ((scores >= 0.3) == np.array(new)).mean() > 0.95
    buried = " ".join([text(False) for _ in range(40)] + [text(True)] + [text(False) for _ in range(40)])
    assert toxicity.score_texts(p, pa.array([buried]))[0] >= 0.3  # every window counts


def test_gradients_are_the_loss_s():
    rng = np.random.default_rng(3)
    p = {k: v.astype(np.float64) for k, v in toxicity.parameters(rng).items()}
    gates = rng.standard_normal((9, 6 * toxicity.HIDDEN)) * 0.5
    places, filled = rng.integers(0, 9, (4, 7)), np.arange(7) < np.array([[7], [3], [1], [5]])
    cache = toxicity.forward(p, gates, places, filled, keep=True)
    grad, d_gates = toxicity.backward(p, gates, places, cache, np.ones(4))
    for name, array, g in [("state", p["state"], grad["state"]), ("attend", p["attend"], grad["attend"]), ("out", p["out"], grad["out"]), ("gates", gates, d_gates)]:
        for _ in range(5):
            at = tuple(rng.integers(0, s) for s in array.shape)
            old, e = array[at], 1e-3
            array[at] = old + e
            up = toxicity.forward(p, gates, places, filled).sum()
            array[at] = old - e
            down = toxicity.forward(p, gates, places, filled).sum()
            array[at] = old
            assert abs((up - down) / (2 * e) - g[at]) < 2e-3 * max(1, abs(g[at])), name


def test_windows_cover_and_overlap():
    first = np.array([0, 0, 5, 5 + 32, 5 + 32 + 100])
    begin, doc = toxicity.windows(first)
    for d in range(4):
        covered = set()
        for b in begin[doc == d]:
            covered |= set(range(b, min(b + 32, first[d + 1])))
        assert covered == set(range(first[d], first[d + 1]))


def test_toxicity_rows(spark):
    docs = documents(spark).union(documents(spark, ["x"], [None]))
    labels = spark.createDataFrame([(3, 1, 0), (4, 1, 1), (None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    rows = toxicity.scores(docs, labels).collect()
    assert len(rows) == len(TEXTS) + 1 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(r["score"] == 0 for r in toxicity.scores(docs, labels.limit(0)).collect())
    assert toxicity.scores(docs.limit(0), labels).count() == 0


# 6

def removed(texts):
    """Brute force: texts by id -> kept words."""
    w = [spaced(t) for t in texts]
    first, hit = {}, [set() for _ in texts]
    for d, x in enumerate(w):
        for i in range(len(x) - 19):
            key = tuple(x[i : i + 20])
            if key in first:
                hit[d] |= set(range(i, i + 20))
            else:
                first[key] = (d, i)
    return [[y for i, y in enumerate(x) if i not in h] for x, h in zip(w, hit)]


@pytest.mark.parametrize("seed", range(4))
def test_substring_dedup_by_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(substring_dedup, "PIECE", 3000)
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range([2, 6, 60, 400][seed])]
    passages = [[rng.choice(vocabulary) for _ in range(rng.choice([19, 20, 21, 55]))] for _ in range(4)]
    texts = []
    for _ in range(40):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w) + 1) : 0] = rng.choice(passages)
        w += rng.choice([[], ["run"] * rng.randrange(60)])
        texts.append(rng.choice([" ", "\n", "  "]).join(w))
    texts[7] = texts[3]
    docs = documents(spark, texts).repartition(5)
    rows = {r["doc_id"]: r for r in substring_dedup.deduplicate(docs).collect()}
    for d, kept in enumerate(removed(texts)):
        assert rows[d]["kept_sha256"] == hashlib.sha256(" ".join(kept).encode()).hexdigest(), d
        assert rows[d]["n_removed"] == len(spaced(texts[d])) - len(kept)
    cut = {r["doc_id"]: r["text"] for r in substring_dedup.without_repeats(docs).collect()}
    assert all(spaced(cut[d]) == kept for d, kept in enumerate(removed(texts)))


def test_substring_cases(spark):
    docs = documents(spark)
    rows = {r["doc_id"]: r for r in substring_dedup.deduplicate(docs).collect()}
    for d, kept in enumerate(removed(TEXTS)):
        assert rows[d]["kept_sha256"] == hashlib.sha256(" ".join(kept).encode()).hexdigest()
    twice = documents(spark, [LONG + " tail", LONG + " tail"], [4, 4])  # a repeated row is not its own copy
    a, b = substring_dedup.deduplicate(twice).collect()
    assert a == b and a["n_removed"] == substring_dedup.deduplicate(twice.limit(1)).first()["n_removed"]
    assert substring_dedup.deduplicate(documents(spark, [LONG], [None])).first()["n_removed"] == 0
    clash = documents(spark, [LONG, None], [None, 1]).withColumn("key", F.lit(1)).withColumn("begins", F.lit("b")).withColumn("ends", F.lit("e")).withColumn("doc", F.lit(2))
    cut = substring_dedup.without_repeats(clash)
    assert cut.columns == clash.columns and sorted(map(str, cut.collect())) == sorted(map(str, clash.collect()))
    assert substring_dedup.deduplicate(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        substring_dedup.repeated_spans(docs, window=10)


# 7

@pytest.fixture(scope="module")
def table():
    return sentencepiece_lattice.pieces()


ODD = ["Hello  world", " lead", "trail ", "a\tb\n\nc", "日本語 テスト 🙂🙂", "▁mark ▁▁ x", "naïve café", "x" * 500, "ab " * 60, " " * 33, *[" " * k + "the" for k in range(20)], "www.example.com/a?b=c&d=%20", "\x00\x7f", "\n x", "Donaudampfschifffahrtsgesellschaftskapitän", "thethethethethetheandandandandinging"]


def own_ids(table, texts):
    c = sentencepiece_lattice.cut(pa.array(texts, pa.string()), table)
    ids, counts = sentencepiece_lattice.ids_of(c, table, *sentencepiece_lattice.own_rule(table)(c.parts))
    assert sentencepiece_lattice.Decoder(table.table).same(ids, counts, c.buffer, c.sizes, block=50).all()
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def test_pieces_are_the_model_s_and_round_trip(table, spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_lattice.MODEL)
    texts = ODD + [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    for t, ids in zip(texts, own_ids(table, texts)):
        assert sentencepiece_lattice.decode(table.table, ids) == t
        if "▁" not in t:
            assert ids == model.encode(t), t[:40]


@pytest.mark.parametrize("broadcast_bytes", [10**9, -1])
def test_all_ids_come_from_the_lattice_and_are_the_model_s(table, spark, monkeypatch, broadcast_bytes):
    """Whole sf0.01, the lexicon sent or joined. The rule in the tasks may only see what no lattice can hold."""
    import sentencepiece

    real = sentencepiece_lattice.Pieces.part

    def only_rest(self, part):
        assert len(part) > sentencepiece_lattice.LONGEST or part not in self.ids and len(part) == 1
        return real(self, part)

    monkeypatch.setattr(sentencepiece_lattice.Pieces, "part", only_rest)
    monkeypatch.setattr(sentencepiece_lattice.Pieces, "merged_alike", None)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet" if broadcast_bytes > 0 else f"{SF}/documents.parquet").select("doc_id", "text").union(documents(spark, ODD, [10**6 + i for i in range(len(ODD))]).select("doc_id", "text"))
    got = {r["doc_id"]: list(r["ids"]) for r in sentencepiece_lattice.encode(docs, broadcast_bytes=broadcast_bytes).collect()}
    model = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_lattice.MODEL)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert got.keys() == texts.keys()
    for d, t in texts.items():
        assert "▁" in t or got[d] == model.encode(t), d


def test_folds_by_brute_force(spark):
    """A made model whose better pieces can come late: both folds against plain rules, on all short strings and some longer ones."""
    rng = random.Random(6)
    alphabet = "abc"
    strings = {"".join(rng.choice(alphabet) for _ in range(n)) for n in (2, 3, 4) for _ in range(14)}
    names = [*alphabet, *sorted(strings)]
    scores = {s: -float(k) for k, s in enumerate(rng.sample(names, len(names)))}
    for unigram in (False, True):
        made = sentencepiece_lattice.Pieces({s: k for k, s in enumerate(names)} | {" ": 99}, scores | {" ": -99.0}, [0] * 256, [b""] * 100, 4, unigram=unigram)
        parts = {"".join(rng.choice(alphabet) for _ in range(n)) for n in (1, 2, 3, 5, 8, 13, 28, 29, 40, 60) for _ in range(60)}
        df = spark.createDataFrame([(p,) for p in parts], "part string")
        got = {r["part"]: list(r["ids"]) for r in sentencepiece_lattice.lexicon(df, made).collect()}
        for p in parts:
            if unigram:
                total = lambda ids: sum(scores[names[i]] for i in ids)
                assert "".join(names[i] for i in got[p]) == p and total(got[p]) == total(made.part(p))
            else:
                assert got[p] == made.part(p), p
        if not unigram:
            codes = np.array([[ord(c) for c in p] for p in parts if len(p) == 8])
            rows = [None] * len(codes)
            for k, ids in made.merged_alike(made._single[codes]):
                for r, i in zip(k, ids):
                    rows[r] = i.tolist()
            assert rows == [made.part(p) for p in parts if len(p) == 8]


def test_encoding_rows(spark):
    docs = documents(spark).union(documents(spark, ["x y", "z"], [None, 3])).withColumn("ids", F.lit(1)).withColumn("lossless", F.lit("no"))
    for size in (10**9, -1):
        e = sentencepiece_lattice.encode(docs, broadcast_bytes=size)
        rows = e.collect()
        assert len(rows) == len(TEXTS) + 2 and all(r["lossless"] and r["n_tokens"] == len(r["ids"]) for r in rows)
        assert {r["doc_id"]: r["text"] for r in sentencepiece_lattice.decoded(e).filter("doc_id < 9 and doc_id <> 3").collect()} == {i: t or "" for i, t in enumerate(TEXTS[:9]) if i != 3}
        assert sentencepiece_lattice.encode(docs.limit(0), broadcast_bytes=size).count() == 0


# 8

@pytest.mark.parametrize("seed", range(3))
def test_decontamination_by_brute_force(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range([3, 12, 200][seed])]
    line = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(str(i), line(rng.choice([0, 1, 4, 13, 14, 30]) if seed else rng.choice([4, 13, 20]))) for i in range(12)]
    docs = []
    for _ in range(30):
        w = line(rng.randrange(50))
        if rng.random() < 0.6:
            item = rng.choice(items)[1]
            w[rng.randrange(len(w) + 1) : 0] = item[: rng.choice([len(item), 12, 13])]
        docs.append(w)
    block = decontaminate.phrases([(i, " ".join(w)) for i, w in items])
    got = list(decontaminate.scan_texts([" ".join(w).encode() for w in docs], block))
    for w, (n, spans, found) in zip(docs, got):
        hit, owners = set(), set()
        for i, item in items:
            size = min(13, len(item))
            for k in range(len(item) - size + 1) if item else ():
                for at in range(len(w) - size + 1):
                    if w[at : at + size] == item[k : k + size]:
                        hit |= set(range(at, at + size))
                        owners.add(i)
        assert n == len(w) and owners == found and {x for s, e in spans for x in range(s, e)} == hit


def test_decontamination_rows(spark):
    bench = spark.createDataFrame([(1, "a b c d e f"), (2, None), (3, ""), (None, "one"), (4, "no such words here")], "item_id long, text string")
    docs = documents(spark)
    rows = {r["doc_id"]: r for r in decontaminate.decontaminate(docs, bench).collect()}
    assert [d for d, r in rows.items() if r["contaminated"]] == [3, 4, 5, 6] and rows[4]["items_sha256"] == hashlib.sha256(b"1").hexdigest()
    blocks = {r["doc_id"]: r for r in decontaminate.decontaminate(docs, bench, block=3).collect()}
    assert blocks == rows  # the benchmark in blocks gives the same
    clash = docs.withColumn("row", F.lit(1)).withColumn("_row", F.lit(2)).withColumn("contaminated", F.lit("x"))
    left = decontaminate.without_contaminated(clash, bench)
    assert (rows[3]["n_hit"], rows[3]["n_items"], rows[3]["items_sha256"]) == (1, 1, hashlib.sha256(b"").hexdigest())
    assert left.count() == len(TEXTS) - 4 and left.columns == clash.columns
    empty = decontaminate.decontaminate(docs, bench.limit(0)).collect()
    assert {r["doc_id"]: r["n_words"] for r in empty} == {d: r["n_words"] for d, r in rows.items()} and not any(r["contaminated"] for r in empty)
    assert decontaminate.decontaminate(docs.limit(0), bench).count() == 0


# 9

def test_packing_by_brute_force():
    rng = random.Random(4)
    for _ in range(50):
        lengths = [rng.randint(1, 30) for _ in range(rng.randrange(60))]
        free: list[int] = []
        for n in sorted(lengths, reverse=True):  # best fit by looking at all rows
            fits = [f for f in free if f >= n]
            if fits:
                free.remove(min(fits))
                free.append(min(fits) - n)
            else:
                free.append(30 - n)
        rows = packing.pack(lengths, 30)
        assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
        assert sorted(30 - sum(lengths[i] for i in r) for r in rows) == sorted(free)
    with pytest.raises(ValueError):
        packing.pack([31], 30)


def test_packed_rows_give_the_documents_back(spark, tmp_path):
    docs = documents(spark)
    docs = docs.union(documents(spark, ["x y", "z", "z", LONG], [None, 5, 5, None])).withColumn("ids", F.lit(1))
    packing.write_packed(docs, str(tmp_path / "p"), length=64)
    rows = spark.read.parquet(str(tmp_path / "p"))
    ids = sorted((r["doc_id"] or -1, list(r["ids"]) + [packing.END]) for r in sentencepiece_lattice.encode(docs).collect())
    assert sorted((r["doc_id"] or -1, list(r["ids"])) for r in packing.unpacked(rows).collect()) == ids
    for r in rows.collect():
        assert len(r["ids"]) == len(r["positions"]) == 128 and r["cu_seqlens"][-1] == r["n_tokens"] <= 64
        places = np.frombuffer(bytes(r["positions"]), "<u2")[: r["n_tokens"]]
        assert places.tolist() == [i for a, b in zip(r["cu_seqlens"], r["cu_seqlens"][1:]) for i in range(b - a)]
        assert set(bytes(r["ids"])[2 * r["n_tokens"] :]) | set(bytes(r["positions"])[2 * r["n_tokens"] :]) <= {0}
    assert packing.packed(docs.limit(0)).count() == 0


# 10

@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_by_brute_force(spark, percent):
    rng = random.Random(percent)
    vocabulary = [f"w{i}" for i in range(500)]
    texts = []
    for _ in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([40, 90, 150]))]
        for _ in range(12):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                k = rng.randrange(len(w))
                w[k : k + 1] = rng.choice([[], [rng.choice(vocabulary)]])
            texts.append(" ".join(x.upper() if rng.random() < 0.1 else x for x in w))
    texts += ["a b", "A  b", "a", "", None]
    sets = []
    for t in texts:
        w = spaced(t, lower=True)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((parent[i], parent[j]))
                parent = [a if x == b else x for x in parent]
    smallest = [min(k for k in range(len(texts)) if parent[k] == parent[i]) for i in range(len(texts))]
    docs = documents(spark, texts).repartition(4).withColumn("n", F.lit(1)).withColumn("bands", F.lit(1))
    got = {r["doc_id"]: r for r in near_dedup.groups(docs, percent=percent).collect()}
    for i, s in enumerate(sets):
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (len(s), smallest[i], smallest[i] == i)
    kept = {r["doc_id"] for r in near_dedup.one_of_each(docs, percent=percent).collect()}
    assert kept == {i for i in range(len(texts)) if smallest[i] == i}


def test_near_duplicate_cases(spark):
    docs = documents(spark).union(documents(spark, ["a b c d e f", "q"], [None, 4]))
    rows = near_dedup.groups(docs).collect()
    by_id = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] != 4}
    assert len(rows) == len(TEXTS) + 2 and by_id[None] is None and by_id[5] == by_id[6] == 4 and by_id[0] == 0 and by_id[1] == 1
    assert near_dedup.groups(docs.limit(0)).count() == 0
    assert near_dedup.groups(documents(spark, ["x y z u v w " * 3, "other"])).count() == 2


def test_rows_that_share_an_id_keep_their_own_links(spark):
    a, b, c = "a b c d e f g", "p q r s t u v", "k l m n o p q"
    docs = documents(spark, [a, a, b, b, b, c, c], [1, 2, 2, 3, 3, None, 2]).withColumn("doc_id__gone", F.lit(1)).withColumn("_gone", F.lit(2)).withColumn("bucket", F.lit(3))
    got = sorted((r["doc_id"] or 0, r["component_id"], r["kept"]) for r in near_dedup.groups(docs).collect())
    assert got == [(0, None, True), (1, 1, True), (2, 1, False), (2, 2, True), (2, 2, True), (3, 2, False), (3, 2, False)]
    left = near_dedup.one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in left.collect()) == [(0, c), (1, a), (2, c), (2, b)][:1] + [(1, a), (2, c), (2, b)]


def test_estimate_is_unbiased(spark):
    rng = np.random.default_rng(1)
    common, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (800, 100, 100))
    low = near_dedup.minima(np.concatenate([common, a, common, b]), np.array([0, 900, 1800]), near_dedup.BANDS * near_dedup.ROWS)
    assert abs((low[0] == low[1]).mean() - 0.8) < 0.12


def test_components(spark):
    edges = [(5, 3), (3, 9), (9, 2), (20, 21), (21, 22), (22, 23), (23, 24), (24, 20), (7, 7)] + [(100, 100 + i) for i in range(1, 30)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in (5, 3, 9, 2)} == {2} and {got[i] for i in range(20, 25)} == {20} and {got[i] for i in range(100, 130)} == {100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# queries and pipeline

@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_equals_its_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.queries()[name](spark, SF)
    columns = sorted(df.columns)
    expected = con.execute(f"SELECT {', '.join(columns)} FROM ({oracle.SQL[name]})").fetchall()
    assert sorted((tuple(r) for r in df.select(columns).collect()), key=repr) == sorted(expected, key=repr)


def test_pipeline_by_brute_force(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "substring_dedup", "decontamination", "sentencepiece"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    toxic = {r["doc_id"] for r in queries.op5_toxicity(spark, SF).collect() if r["predicted"]}
    clean = stages["toxicity"](spark, docs, SF)
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.select("doc_id").collect()} == {r["doc_id"] for r in docs.select("doc_id").collect()} - toxic
    whole = docs.orderBy("doc_id").collect()
    texts = [r["text"] for r in whole]
    sets = [{tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set() for w in (spaced(t, lower=True) for t in texts)]
    reach = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                low, high = sorted((reach[i], reach[j]))
                reach = [low if r == high else r for r in reach]
    kept = [r["doc_id"] for i, r in enumerate(whole) if reach[i] == i]
    one = stages["near_dedup"](spark, docs, SF)
    assert one.columns == docs.columns and len(kept) < len(whole) and sorted(r["doc_id"] for r in one.select("doc_id").collect()) == kept
    cut = stages["substring_dedup"](spark, docs, SF)
    rows = cut.orderBy("doc_id").collect()
    assert cut.columns == docs.columns and [spaced(r["text"]) for r in rows] == removed(texts) and all(r["n_chars"] == len(r["text"]) for r in rows)
    bad = {r["doc_id"] for r in queries.op8_decontamination(spark, SF).collect() if r["contaminated"]}
    assert bad and {r["doc_id"] for r in stages["decontamination"](spark, docs, SF).collect()} == {r["doc_id"] for r in docs.collect()} - bad
    out = corpus_pipeline.run(spark, SF)
    assert out.filter("not lossless").count() == 0 and 0 < out.count() < docs.count()
