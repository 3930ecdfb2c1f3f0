from collections import Counter

from moraine.llm import decontaminate

ROWS = [(1, "a b c d"), (1, "a b c d"), (1, "x y z u"), (None, "a b c d"), (None, "x y z u"), (None, "e f g h"), (None, None), (2, "q"), (2, "q")]


def test_rows_stay_rows_however_many_blocks(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([(1, "a b c d"), (2, "e f g h"), (3, "no such words")], "item_id long, text string")
    one, many = (Counter(map(tuple, decontaminate.decontaminate(docs, bench, block=b).collect())) for b in (10**6, 2))
    assert len(list(decontaminate.blocks(bench, block=2))) == 3
    assert one == many and sum(many.values()) == len(ROWS) and sum(n for r, n in many.items() if r[-1]) == 4
    for b in (10**6, 2):
        left = decontaminate.without_contaminated(docs, bench, block=b)
        assert left.columns == docs.columns
        assert Counter(map(tuple, left.collect())) == Counter(r for r in ROWS if r[1] not in ("a b c d", "e f g h"))
