"""Operators 1 and 7: held-out accuracy, counts and robust estimates against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from motorlake.llm import robust_outliers as R
from motorlake.llm import rule_ensemble as E

SF = "/root/testdata/sf0.01"
ODD = [None, "", " ", "\n\n", "a", "a b c a b c", "a a a a a", "a b c\na b c\n a b c\n\n", "x\x0by\x0cz\r\n\tw x\x0by z", "#*$%&|<>", "é ü 日本 & 語",
       "a b c d a b c e a b", "one\n" * 60, "w" * 20000, " ".join(f"v{i % 7}" for i in range(3000)), "a b a b a b a"]


def brute_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    counts = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
    return *counts, counts[0] < 50 or 100 * counts[4] > 50 * counts[0]


def random_texts(n):
    rng = random.Random(4)
    return ["".join(rng.choice(["a", "bb", "c", "#", "é"]) + rng.choice([" ", "  ", "\n", "\t", " "]) for _ in range(rng.randint(0, 200))) for _ in range(n)]


def test_counts_equal_brute_force(spark):
    rows = [(i, t, "en", "s", "clash") for i, t in enumerate(ODD + random_texts(80))] + [(None, "a b c", None, None, None), (5, ODD[5], "en", "s", "clash")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words string").repartition(5)
    got = R.quality_rules(docs).collect()
    assert len(got) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_counts(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def c_steps(x, mean, cov, steps=100):
    h = math.ceil(R.COVERED * len(x))
    for _ in range(steps):
        cov = R.CONSISTENCY * cov
        cov[np.diag_indices(len(mean))] = np.maximum(np.diag(cov), np.array(R.FLOORS) ** 2)
        d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
        near = x[np.argsort(d, kind="stable")[:h]]
        mean, cov = near.mean(axis=0), np.cov(near.T, bias=True)
    cov = R.CONSISTENCY * cov
    cov[np.diag_indices(len(mean))] = np.maximum(np.diag(cov), np.array(R.FLOORS) ** 2)
    return mean, cov


def brute_mcd(x, starts=40):
    """FAST-MCD: concentration from random small subsets, the least determinant wins."""
    rng = np.random.default_rng(0)
    best = None
    for _ in range(starts):
        part = x[rng.choice(len(x), 8, replace=False)]
        mean, cov = c_steps(x, part.mean(axis=0), np.cov(part.T, bias=True), 30)
        det = np.linalg.slogdet(cov)[1]
        if best is None or det < best[0]:
            best = det, mean, cov
    return best


@pytest.mark.parametrize("share", [0.0, 0.1, 0.2])
def test_estimates_equal_fast_mcd(spark, share):
    rng = np.random.default_rng(9)
    n = 800
    a = rng.normal(size=(4, 4)) * .3 + np.eye(4)
    x = rng.normal(size=(n, 4)) @ a.T + [2, 3, 4, 5]
    out = rng.random(n) < share
    x[out] = rng.normal(size=(out.sum(), 4)) * .3 + [9, -4, 12, 1]
    ints = np.round(x * R.UNIT).astype(int)
    rows = spark.createDataFrame([("g", *map(int, r)) for r in ints], "group string, x0 long, x1 long, x2 long, x3 long").repartition(4)
    r = R.mcd_estimates(rows).first()
    low = np.array([[r[f"l{i}{j}"] if j <= i else 0.0 for j in range(4)] for i in range(4)])
    mean, cov = np.array([r[f"m{i}"] for i in range(4)]), low @ low.T
    det, want_mean, want_cov = brute_mcd(ints / R.UNIT)
    assert np.linalg.slogdet(cov)[1] < det + 0.15
    assert np.abs(mean - want_mean).max() < 0.15 and np.abs(cov - want_cov).max() < 0.35
    d = lambda m, c: np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
    assert (d(mean, cov) > R.CUTOFF)[out].all()
    assert ((d(mean, cov) > R.CUTOFF) == (d(want_mean, want_cov) > R.CUTOFF)).mean() > 0.99


def test_junk_is_rejected_and_plain_texts_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = R.quality_rules(docs)
    assert "Python" not in got._jdf.queryExecution().toString() and "Arrow" not in got._jdf.queryExecution().toString()
    judged = got.filter("NOT base_failed").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    kept = {r.quality: (r.k, r.n) for r in judged.groupBy("quality").agg(F.sum(F.col("kept").cast("int")).alias("k"), F.count("*").alias("n")).collect()}
    assert kept[1][0] >= 0.97 * kept[1][1] and kept[0][0] <= 0.1 * kept[0][1]


def test_small_groups_use_wider_estimates(spark):
    rng = random.Random(8)
    text = lambda junk: " ".join("".join(rng.choices("abcde", k=rng.randint(3, 7))) + ("$$$" if junk else "") for _ in range(200))
    rows = [(i, text(False), "en", "big") for i in range(120)] + [(200, text(False), "en", "tiny"), (201, text(True), "en", "tiny"), (202, text(True), None, None), (203, text(False), None, None)]
    got = {r.doc_id: r.kept for r in R.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert [got[i] for i in (200, 201, 202, 203)] == [True, False, False, True] and sum(got[i] for i in range(120)) >= 118


# ---------------------------------------------------------------- rule ensemble

@pytest.fixture(scope="module")
def model(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return E.train(docs, labels)


def test_held_out_accuracy(spark, model):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = E.score_documents(docs, model)
    right, n = got.join(labels, "doc_id").filter("held_out").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert got.count() == docs.count() and n > 80 and right > 0.95
    assert 1 < len(model.rules) < 120 and got.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_rules_are_read_from_trees():
    debug = """RandomForestClassificationModel: uid=x, numTrees=2
  Tree 0 (weight 1.0):
    If (feature 2 <= 0.5)
     If (feature 0 <= 3.0)
      Predict: 0.0
     Else (feature 0 > 3.0)
      Predict: 1.0
    Else (feature 2 > 0.5)
     If (feature 2 <= 0.9)
      Predict: 1.0
     Else (feature 2 > 0.9)
      Predict: 0.0
  Tree 1 (weight 1.0):
    If (feature 2 <= 0.5)
     Predict: 0.0
    Else (feature 2 > 0.5)
     Predict: 1.0
"""
    assert E.tree_rules(debug) == [((2, "<=", 0.5),), ((0, "<=", 3.0), (2, "<=", 0.5)), ((0, ">", 3.0), (2, "<=", 0.5)), ((2, ">", 0.5),),
                                   ((2, "<=", 0.9), (2, ">", 0.5)), ((2, ">", 0.9),)]


def test_compiled_expression_equals_the_rules(spark, model):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(ODD)] + [(None, "a b", None), (3, ODD[3], "x")], "doc_id long, text string, words string")
    stats = {(r.doc_id, i): r for i, r in enumerate(E.statistics(docs, "doc_id").withColumn("score", model.score()).collect())}
    assert len(stats) == len(ODD) + 2
    for r in stats.values():
        fires = lambda rule: all((r[E.STATISTICS[f]] <= x) if op == "<=" else (r[E.STATISTICS[f]] > x) for f, op, x in rule)
        total = model.intercept + sum(w for rule, w in model.rules if fires(rule))
        assert math.isclose(r.score, 1 / (1 + math.exp(-total)), rel_tol=1e-9)
    out = E.score_documents(docs, model).collect()
    assert all(r.held_out for r in out if r.doc_id is None) and all(r.predicted in (0, 1) for r in out)


def test_degenerate_labels_and_empty_tables(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id long, text string")
    ones = spark.createDataFrame([(i, 1) for i in range(20)] + [(1, None), (None, 0)], "doc_id long, quality int")
    assert {r.predicted for r in E.score_documents(docs, E.train(docs, ones)).collect()} == {1}
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert E.score_documents(none, E.train(none, ones)).count() == 0 and R.quality_rules(none).count() == 0
