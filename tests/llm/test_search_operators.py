"""Operators 4, 6, 8 and 10 against brute force on small tables."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from motorlake.llm import decontaminate, language_id, line_dedup, near_dup
from motorlake.llm.common import held_out, shingle_hashes, word_hasher

SMALL = "/root/testdata/sf0.001/documents.parquet"


def shingles(text, k=5):
    w = re.findall(r"\w+", (text or "").lower())
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def weighted(text, k=5):
    w = re.findall(r"\w+", (text or "").lower())
    grams = [tuple(w[i:i + k]) for i in range(len(w) - k + 1)] or ([tuple(w)] if w else [])
    return {g: 1 + math.log(c) for g, c in Counter(grams).items()}


def probability_jaccard(x, y):
    """By the definition, element by element."""
    union = sorted(x.keys() | y.keys())
    xs, ys = (np.array([side.get(e, 0.0) for e in union]) for side in (x, y))
    return sum(1 / np.maximum(xs / x[d], ys / y[d]).sum() for d in x.keys() & y.keys())


def words(rng, n):
    return [f"w{rng.randint(0, 3000)}" for _ in range(n)]


def edited(rng, w, share):
    return [f"x{rng.randint(0, 9999)}" if rng.random() < share else x for x in w]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(words(rng, rng.randint(1, 120)))) for i in range(0, 60)]
    base = words(rng, 150)
    rows += [(100 + i, " ".join(edited(rng, base, 0.012))) for i in range(60)]       # copies near each other or not, hub needed
    rows += [(200 + i, rows[3][1].upper() + "!") for i in range(20)]                   # copies but for case and punctuation
    rows += [(300, "one two"), (301, "One, two."), (302, "one two three"), (303, ""), (304, None), (305, " \n "), (306, ""), (None, "one two"),
             (307, "a b c " * 2000), (307, "a b c " * 2000), (308, "a b c " * 1999)]
    return spark.createDataFrame([(i, t, -1, "x") for i, t in rows], "doc_id long, text string, class_id int, digest string").repartition(6)


def brute_classes(rows):
    sets = [(i, weighted(t)) for i, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x == y and x or not x.keys().isdisjoint(y.keys()) and probability_jaccard(x, y) >= 0.8 - 1e-9:
                parent[root(a)] = root(b)
    least = {}
    for n, (i, _) in enumerate(sets):
        if i is not None:
            least[root(n)] = min(i, least.get(root(n), i))
    return sorted(((i, least.get(root(n))) for n, (i, _) in enumerate(sets)), key=str)


@pytest.mark.parametrize("hubs", [1, 32])
def test_near_duplicate_classes_equal_brute_force(corpus, hubs):
    rows = [(r.doc_id, r.text) for r in corpus.collect()]
    got = near_dup.near_duplicate_classes(corpus, hubs=hubs).collect()
    assert sorted(((r.doc_id, r.class_id) for r in got), key=str) == brute_classes(rows)


def test_one_of_each_stays(corpus):
    got = near_dup.keep_one_of_each(corpus)
    assert got.columns == corpus.columns
    ids = [r.doc_id for r in got.collect()]
    assert len(ids) == len(set(ids)) and {3, 300, 302, 303, 304, 307, None} <= set(ids) and not {200, 301, 308} & set(ids)


def test_prob_minhash_estimates_probability_jaccard():
    rng = np.random.default_rng(5)
    common, own = rng.integers(1, 2 ** 63, 300, dtype=np.uint64), rng.integers(1, 2 ** 63, 200, dtype=np.uint64)
    a, b = np.concatenate([common, own[:100]]), np.concatenate([common, own[100:]])
    wa, wb = rng.uniform(1, 4, 400), rng.uniform(1, 4, 400)
    sig = near_dup.prob_minhash(np.concatenate([a, b]), np.concatenate([wa, wb]), np.repeat([0, 1], 400), 2, 1024)
    x, y = dict(zip(a.tolist(), wa)), dict(zip(b.tolist(), wb))
    true = sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in x.keys() | y.keys()) for d in x.keys() & y.keys())
    assert abs((sig[0] == sig[1]).mean() - true) < 0.06


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (200, 201)]
    got = {r.node: r.label for r in near_dup.components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}, 201: 200}


def test_shingles_respect_text_ends():
    texts = ["a b c d e f", "", "a b", "a b c d e", "x"]
    hashes, offsets = shingle_hashes([word_hasher().of(t) for t in texts])
    assert np.diff(offsets).tolist() == [2, 0, 1, 1, 1] and hashes[0] == hashes[3] and len(set(hashes.tolist())) == 4


def test_contained_items_equal_brute_force(spark):
    rng = random.Random(11)
    items = [(i, " ".join(words(rng, n))) for i, n in enumerate([5, 6, 9, 12, 20, 33, 40, 70, 300, 3])]
    items += [(50, None), (51, ""), (52, items[4][1]), (None, items[5][1])]
    rows = [(i, " ".join(words(rng, rng.randint(0, 3000)))) for i in range(30)]
    for n, (_, text) in enumerate(items[:10]):
        w = text.split()
        for keep in (1.0, 0.95, 0.85, 0.7, 0.4):
            host = words(rng, rng.randint(0, 2500))
            at = rng.randint(0, len(host))
            part = w[:max(1, round(len(w) * keep))] if n % 2 else edited(rng, w, (1 - keep) / 5)
            rows.append((len(rows) + 100, " ".join(host[:at] + [x.title() + "," for x in part] + host[at:])))
    rows += [(900, None), (901, ""), (902, "too short"), (902, "too short"), (None, items[6][1])]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, item_id string").repartition(4)
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    want = []
    for i, t in rows:
        for j, u in items:
            q = shingles(u)
            if u and len(u.split()) >= 5 and len(q & shingles(t)) >= 0.8 * len(q):
                want.append((i, j, len(q & shingles(t)), len(q)))
    got = [tuple(r) for r in decontaminate.contaminated(docs, bench).collect()]
    assert len(want) > 20 and sorted(got, key=str) == sorted(want, key=str)
    left = decontaminate.drop_contaminated(docs, bench)
    assert left.columns == docs.columns and left.count() == sum(1 for i, _ in rows if i not in {w[0] for w in want})


def test_many_blocks_give_the_same_rows(spark, monkeypatch):
    docs = spark.read.parquet(SMALL)
    bench = spark.read.parquet(SMALL.replace("documents", "benchmark"))
    want = sorted(map(tuple, decontaminate.contaminated(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 7)
    assert want and sorted(map(tuple, decontaminate.contaminated(docs, bench).collect())) == want


# ---------------------------------------------------------------- line dedup

def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@pytest.mark.parametrize("seed", range(30))
def test_patience_is_an_alignment(seed):
    rng = random.Random(seed)
    a = rng.sample(range(1000), rng.randint(0, 30))
    b = [x for x in a if rng.random() < .7]
    for _ in range(rng.randint(0, 10)):
        b.insert(rng.randint(0, len(b)), rng.choice([*range(2000, 2005), *a, 1]))
    got = line_dedup.patience(a, b)
    assert all(a[i] == b[j] for i, j in got)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))
    if len(set(b)) == len(b):
        assert len(got) == lcs(a, b)        # without repeats patience finds a longest alignment


def brute_dedup(rows, anchor_words, block_words):
    """All documents held in memory, each later one aligned with the first holder of each of its lines."""
    lines = {}
    for i, t in rows:
        if i is not None and t is not None:
            lines.setdefault(i, [" ".join(x.split()) for x in t.split("\n") if x.strip()])
    first, count = {}, Counter()
    for i in sorted(lines):
        for x in set(lines[i]):
            first.setdefault(x, i)
            count[x] += 1
    out = {}
    for i, own in lines.items():
        gone = set()
        for partner in {first[x] for x in own if len(x.split()) >= anchor_words and first[x] < i}:
            other = lines[partner]
            a = [(n, x, len(x.split())) for n, x in enumerate(other) if count[x] > 1]
            b = [(n, x, len(x.split())) for n, x in enumerate(own) if count[x] > 1]
            gone |= {n for n, _ in line_dedup.repeated_lines(a, b, block_words)}
        out[i] = gone
    return out


def test_lines_equal_brute_force(spark):
    rng = random.Random(2)
    pool = [" ".join(words(rng, rng.choice([1, 3, 6, 12, 60]))) for _ in range(40)]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < .4 else " ".join(words(rng, rng.randint(0, 30))) for _ in range(rng.randint(0, 12)))) for i in range(80)]
    rows += [(200 + i, rows[5][1]) for i in range(5)] + [(300, None), (301, ""), (302, "\n\n"), (303, pool[4] + "\n" + "long " * 5000), (None, rows[5][1])]
    rows += [(304, "  " + pool[4].replace(" ", "  ") + "\r\nnew")] * 2
    docs = spark.createDataFrame([(i, t, 1, "n") for i, t in rows], "doc_id long, text string, hash int, n_lines string").repartition(5)
    want = brute_dedup(rows, 5, 10)
    got = line_dedup.deduplicate_lines(docs).collect()
    assert len(got) == len(rows) and line_dedup.deduplicate_lines(docs).columns == ["doc_id", "text", "hash", "n_lines", "n_removed"]
    texts = dict(rows)
    for r in got:
        own = [x for x in (texts[r.doc_id] or "").split("\n") if x.strip()]
        gone = want.get(r.doc_id, set())
        assert (r.n_lines, r.n_removed) == (len(own), len(gone))
        assert r.text == ("\n".join(x for n, x in enumerate(own) if n not in gone) if gone else texts[r.doc_id])
    assert sum(r.n_removed for r in got) > 50


# ---------------------------------------------------------------- language ID

def brute_viterbi(scores, switch):
    best = {k: scores[0][k] for k in range(scores.shape[1])}
    for row in scores[1:]:
        best = {k: row[k] + max(v - switch * (j != k) for j, v in best.items()) for k in best}
    return max(best.values())


@pytest.mark.parametrize("seed", range(20))
def test_viterbi_finds_the_best_path(seed):
    rng = np.random.default_rng(seed)
    scores = -rng.uniform(0, 6, (rng.integers(1, 60), 3)) + np.repeat(rng.uniform(-3, 3, (6, 3)), 10, axis=0)[:1]
    if seed % 2:
        scores[len(scores) // 2:, seed % 3] += 4
    path = language_id.viterbi(scores, 5.0)
    value = scores[np.arange(len(scores)), path].sum() - 5.0 * (path[1:] != path[:-1]).sum()
    assert np.isclose(value, brute_viterbi(scores, 5.0))


def test_language_accuracy_and_edge_cases(spark):
    docs = spark.read.parquet(SMALL.replace("0.001", "0.01"))
    model = language_id.train(docs, 400)
    got = language_id.identify(docs, model).filter(held_out(F.col("doc_id")))
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 150 and right > 0.97
    texts = {lang: next(r.text for r in docs.filter(F.col("lang") == lang).orderBy(F.desc("n_chars")).take(1)).split()[:80] for lang in ("de", "es")}
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 34 ... !"), (4, "日本語 한국어"), (4, " ".join(texts["de"] + texts["es"])), (None, "the of and")],
                                "doc_id long, text string").withColumn("lang_pred", F.lit("clash"))
    out = sorted(((r.doc_id or 0, r.lang_pred, r.score) for r in language_id.identify(odd, model).collect()))
    assert [x[1:] for x in out if x[0] in (1, 2, 3)] == [("und", 0.0)] * 3 and out[0][1] == "en" and out[0][2] == 1.0
    late = "x" * 500 + "".join(w for w in texts["de"]) * 3         # no blank: labelled by all of it, not by its start
    assert language_id.identify(spark.createDataFrame([(1, late)], "doc_id long, text string"), model).first().lang_pred == "de"
    spans = [(r.lang, r.n_words) for r in language_id.label_spans(odd, model).filter("doc_id = 4").orderBy("span").collect() if r.n_words > 20]
    assert [s for s, _ in spans] == ["de", "es"] and all(abs(n - 80) <= 3 for _, n in spans)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert near_dup.near_duplicate_classes(none).count() == 0
    assert line_dedup.deduplicate_lines(none).count() == 0
    assert decontaminate.contaminated(none, items).count() == 0
    assert decontaminate.contaminated(spark.createDataFrame([(1, "a b c d e")], "doc_id long, text string"), items).count() == 0
    assert language_id.identify(none, language_id.train(none)).count() == 0


def test_letters_and_scripts_of_no_language(spark):
    """Numerals are no letters; letters of scripts that no learned language uses count for none."""
    docs = spark.read.parquet(SMALL.replace("0.001", "0.01"))
    model = language_id.train(docs, 400)
    odd = spark.createDataFrame([(1, "½ ² Ⅷ ①"), (2, "Καλημέρα κόσμε"), (3, "สวัสดี"), (4, "the of and " * 5 + "κόσμε" * 10)], "doc_id long, text string")
    odd = odd.withColumn("a.b", F.lit(1))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(odd, model).collect()}
    assert got[1] == ("und", 0.0)
    assert got[2][0] in model.languages and got[2][1] == 0.0 and got[3][1] == 0.0
    assert got[4][0] == "en" and 0.4 < got[4][1] < 0.45


def test_line_dedup_keeps_clashing_columns(spark):
    text = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(1, text, "a", "b", "c"), (2, text + "\nown line here", "a", "b", "c")],
                                 "doc_id long, text string, deleted string, __id string, `kept.lines` string")
    got = line_dedup.deduplicate_lines(docs)
    assert got.columns == [*docs.columns, "n_lines", "n_removed"]
    assert {r.doc_id: (r.text, r.deleted) for r in got.collect()} == {1: (text, "a"), 2: ("own line here", "a")}
