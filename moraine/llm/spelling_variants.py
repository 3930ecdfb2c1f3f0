"""Spelling variants: words one edit apart, by a rare-first q-gram prefix filter.

All bigrams are ordered once, rarest first by the number of their places in all
words; a word's prefix is its three first bigrams in that order (equal ones by
place). One edit destroys at most two of a word's bigrams and makes at most
two, and those that survive keep their order. So the first survivor is among
the first three of both words: the prefixes of near words always meet.

The edit also says where: it stands on one side of that bigram, and in one half
of what is there, so all else is equal. A replaced letter keeps the length and
every place, an inserted one adds one to the length and none or one to the
place. Words meet by an equi-join on the bigram, its place, the length and what
must be equal then, and Levenshtein's distance decides at once, before anything
is shuffled again. Joined by bigram, place and length alone, 282,392 words have
393 million candidates. Everything is
DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moraine.llm.common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Letters of a run once A-Z are lower-cased.
LETTERS = "a-zÀ-ÿ"
#: Bigrams that make a prefix: an edit destroys at most two, and makes at most two.
PREFIX = 3


def vocabulary(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shortest: int = 5, least: int = 3, modulus: int = 97) -> DataFrame:
    """``word, n`` of all texts: runs of letters, one in ``modulus`` of which loses the letter that its hash names.

    Runs shorter than ``shortest`` never make a word, so the pattern leaves them out.
    """
    lowered = F.translate(F.col(text), UPPER, LOWER)
    runs = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(lowered, F.lit(f"[{LETTERS}]{{{shortest},}}"), F.lit(0))).alias("run"),
    )
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.expr("cast(h % length(run) as int)")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % modulus == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def prefixes(words: DataFrame) -> DataFrame:
    """``word, len, pos``: the places (from 0) of each word's three rarest bigrams.

    ``words`` has an ``id`` for each word, which stands for it while its
    bigrams are apart. Bigrams over the letters of runs are at most 90 x 90,
    whatever the input, so the table of their ranks is broadcast.
    """
    spelt = words.select("id", F.length("word").alias("len"), F.split("word", "").alias("letters"))
    grams = spelt.select("id", F.posexplode(F.transform(F.sequence(F.lit(1), F.col("len") - 1), lambda i: F.concat(F.get("letters", i - 1), F.get("letters", i)))).alias("pos", "gram"))
    counts = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("places"))
    order = counts.agg(F.sort_array(F.collect_list(F.struct("places", "gram"))).alias("all")).select(F.posexplode("all").alias("rank", "one")).select("rank", F.col("one.gram").alias("gram"))
    ranked = grams.join(F.broadcast(order), "gram").groupBy("id").agg(F.slice(F.sort_array(F.collect_list(F.struct("rank", "pos"))), 1, PREFIX).alias("first"))
    return words.join(ranked, "id").select("word", F.length("word").alias("len"), F.explode("first.pos").alias("pos"))


def _cut(a: Column | int, b: Column | None = None) -> Column:
    """Letters ``a`` to ``b`` of the word."""
    a = F.lit(a) if isinstance(a, int) else a
    return F.substring("word", a + 1, (F.col("len") if b is None else b) - a)


def _keys(longer: bool) -> Column:
    """What must be equal in a near word, hashed, for each place the edit can have: left or right of the bigram, near it or far.

    ``longer``: as the word that has one letter more. Named after the place and
    the length in the shorter word, whose part next to the bigram is halved.
    """
    more = 1 if longer else 0
    pos, size = F.col("pos"), F.col("len") - more
    after, before = size - pos - 2, pos - more
    half_after, half_before = F.floor(after / 2).cast("int"), F.floor(before / 2).cast("int")
    start = pos + 2 + half_after
    nothing = F.lit("")

    def key(kind: int, there: Column, place: Column, *equal: Column) -> Column:
        return F.when(there, F.xxhash64(F.lit(kind), place, size, *equal))

    return F.array_compact(
        F.array(
            key(0, after >= 0, pos, _cut(0, start), nothing),
            key(1, half_after > 0, pos, _cut(0, pos + 2), _cut(start + more)),
            key(2, before >= 0, before, _cut(0, half_before), _cut(pos)),
            key(3, half_before > 0, before, nothing, _cut(half_before + more)),
        )
    )


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, n_a, b, n_b``: each pair of ``words`` (``id, word, n``) that one inserted, deleted or replaced letter tells apart, once."""
    own = written(prefixes(words))
    equal = own.select("word", F.explode(_keys(False)).alias("key"))
    longer = own.select("word", F.explode(_keys(True)).alias("key"), F.lit(True).alias("longer"))
    asked = equal.select(F.col("word").alias("a"), "key")
    met = equal.withColumn("longer", F.lit(False)).unionByName(longer).withColumnRenamed("word", "b").join(asked, "key").filter(F.col("longer") | (F.col("a") < F.col("b")))
    pairs = met.filter(F.levenshtein("a", "b", 1) == 1).select("a", "b").distinct()
    counts = [words.select(F.col("word").alias(x), F.col("n").alias(f"n_{x}")) for x in ("a", "b")]
    return pairs.join(counts[0], "a").join(counts[1], "b").select("a", "n_a", "b", "n_b")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``word, form`` rows: each form is followed to the last one.

    Every round replaces a word's target by its target's target, so the rounds
    grow with the logarithm of the longest chain. A form's count is at least
    twice the word's, so a chain has at most 63 links and six rounds suffice.
    """
    now = written(forms.select("word", F.col("form").alias("root")))
    while True:
        nxt = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = written(now.join(nxt, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        now = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return now


def variants(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shortest: int = 5, least: int = 3, modulus: int = 97, factor: int = 2) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of all texts.

    A word's form is its near word of largest count (ties: the smallest in
    code-point order) if that count is at least ``factor`` times its own; its
    root is the end of the chain of forms. Null and empty texts have no words;
    a null id hashes as an empty one; repeated rows count as often as they
    stand. An empty table gives no rows; other columns are ignored.
    """
    if shortest < PREFIX + 1:
        raise ValueError(f"words need {PREFIX + 1} letters at least, that is {PREFIX} bigrams")
    words = written(vocabulary(docs, key=key, text=text, shortest=shortest, least=least, modulus=modulus).withColumn("id", F.monotonically_increasing_id()))
    both = near_pairs(words).select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
                F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")),
            )
        ).alias("one")
    ).select("one.*")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    enough = F.col("best").isNotNull() & (-F.col("best.minus") >= factor * F.col("n"))
    joined = written(
        words.join(best, "word", "left").select(
            "word",
            F.when(enough, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, -F.col("best.minus")).alias("form_n"),
        )
    )
    ends = roots(joined.filter("form is not null"))
    return joined.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
