"""Benchmark items of few shingles inside long documents."""

import random

from motorlake.llm import decontaminate


def test_short_items_in_long_documents_are_all_found(spark):
    rng = random.Random(3)
    word = lambda: f"w{rng.randint(0, 10 ** 6)}"
    items = [(i, " ".join(word() for _ in range(5 + i % 8))) for i in range(400)]
    rows = [(i, " ".join([word() for _ in range(rng.choice([0, 40, 300]))] + text.split() + [word() for _ in range(300)])) for i, text in items]
    rows += [(1000 + i, " ".join(text.split()[1:] + [word() for _ in range(60)])) for i, text in items if i % 8 == 0]     # four of five words: no shingle
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(map(tuple, got)) == [(i, i, i % 8 + 1, i % 8 + 1) for i, _ in items]


def test_items_that_repeat_themselves_are_found(spark):
    rng = random.Random(5)
    word = lambda: f"w{rng.randint(0, 10 ** 6)}"
    items = [(i, " ".join([word() for _ in range(20)] * 25)) for i in range(60)]
    rows = [(i, " ".join([word() for _ in range(700)] + text.split() + [word() for _ in range(700)])) for i, text in items]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(map(tuple, got)) == [(i, i, 20, 20) for i, _ in items]
