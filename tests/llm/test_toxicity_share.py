import random
import zlib

from moraine.llm import toxicity

WORDLESS = [None, "", "  ", "... !?", "-- \n --"]


def labelled(spark, toxic, clean):
    """As many learnable labels of either class, each with a short text; wordless documents come after them."""
    rng = random.Random(3)
    ids = (i for i in range(10**6) if zlib.crc32(str(i).encode()) % 4 != 2)
    rows = [(next(ids), y) for y in [1] * toxic + [0] * clean]
    docs = [(i, " ".join(rng.choice("abcdefgh") for _ in range(6)) + (" zzork" if y else "")) for i, y in rows]
    docs += [(10**6 + k, t) for k, t in enumerate(WORDLESS)]
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(rows, "doc_id long, toxic int")


def test_wordless_texts_do_not_follow_the_sample_s_classes(spark):
    docs, labels = labelled(spark, 1700, 13_000)
    fit = toxicity.Fit(epochs=1)
    texts, toxic, prior = toxicity.sample(docs, labels, fit)
    assert abs(sum(toxic) / len(toxic) - 1 / 3) < 0.02 and abs(prior - 1700 / 14_700) < 1e-6
    rows = [r for r in toxicity.scores(docs, labels, fit).filter("doc_id >= 1000000").collect()]
    assert len(rows) == len(WORDLESS) and all(abs(r["score"] - 1700 / 14_700) < 1e-6 and r["predicted"] == 0 for r in rows)
    assert toxicity.without_toxic(docs, labels, fit).filter("doc_id >= 1000000").count() == len(WORDLESS)


def test_long_texts_take_no_place_in_the_sample(spark):
    docs, labels = labelled(spark, 300, 900)
    long = docs.filter("doc_id % 5 <> 0").selectExpr("doc_id", "repeat(text, 500) AS text")
    texts, toxic, prior = toxicity.sample(docs.filter("doc_id % 5 = 0").union(long), labels, toxicity.Fit(positives=1500, negatives=100))
    n = labels.filter("doc_id % 5 = 0 AND toxic = 0").count()
    assert max(len(t) for t in texts) <= 2500 and abs(prior - 0.25) < 1e-6
    assert n > 150 and abs(len(toxic) - sum(toxic) - 100) < 30  # about 100 of those n, not a fifth of 100
