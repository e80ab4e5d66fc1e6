"""Near duplicates whose shingles occur very unequally often: one measure decides, in sketches, filter and links."""

import random

import numpy as np

from motorlake.llm import near_dup
from motorlake.llm.common import word_hasher
from test_search_operators import brute_classes, probability_jaccard, weighted


def pair(rng, n, paragraph, times):
    w = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(n)]
    return " ".join(w), " ".join(w + w[20:20 + paragraph] * times)


def counted(texts):
    element, count, owner = near_dup.counted_sets([word_hasher().of(t) for t in texts], 5)
    return element, near_dup.weights(count), owner


def test_sketches_estimate_probability_jaccard():
    for times in (1, 8, 30):
        texts = pair(random.Random(4), 224, 44, times)
        element, weight, owner = counted(texts)
        sig = near_dup.prob_minhash(element, weight, owner, 2, 2048)
        assert abs((sig[0] == sig[1]).mean() - probability_jaccard(*map(weighted, texts))) < 0.04


def test_exact_similarity_equals_its_definition():
    rng = random.Random(5)
    for _ in range(60):
        texts = pair(rng, rng.randint(30, 300), rng.randint(6, 60), rng.randint(0, 40))
        element, weight, owner = counted((texts[0], texts[1] + " " + texts[0][:rng.randint(0, 400)]))
        a, b = owner == 0, owner == 1
        x, y = dict(zip(element[a].tolist(), weight[a])), dict(zip(element[b].tolist(), weight[b]))
        got = near_dup.probability_jaccard(element[a], weight[a], element[b], weight[b])
        assert abs(got - probability_jaccard(x, y)) < 1e-9
    assert near_dup.probability_jaccard(np.array([1]), np.ones(1), np.array([2]), np.ones(1)) == 0


def test_repeated_paragraphs_equal_brute_force(spark):
    rng = random.Random(9)
    rows = []
    for i, times in enumerate([0, 1, 2, 3, 4, 6, 8, 12, 20, 30, 60, 100] * 3):
        texts = pair(rng, rng.randint(150, 400), rng.randint(20, 64), times)
        rows += [(10 * i, texts[0]), (10 * i + 1, texts[1]), (10 * i + 2, texts[1] + " end")]
    want = brute_classes(rows)
    assert len({c for _, c in want}) not in (36, 108)           # some repeats are a link, some are not
    got = near_dup.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted(((r.doc_id, r.class_id) for r in got), key=str) == want
