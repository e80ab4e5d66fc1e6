"""Importance resampling against a plain version, and the scan against a split into words."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from conftest import SMALL
from motorlake.llm import ngram_resampling as R
from motorlake.llm.common import table

SCHEMA = "doc_id long, text string"


def words_of(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def buckets_of(text, longest=2):
    w = words_of(text)
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10000 for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def plain(docs, targets):
    s, t = [0] * 10000, [0] * 10000
    for into, texts in ((s, [x for _, x in docs]), (t, targets)):
        for text in texts:
            for b in buckets_of(text):
                into[b] += 1
    big_s, big_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in range(10000)]
    rows, fit = [], []
    for doc, text in docs:
        f = buckets_of(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, len(f), weight, score, None])
        if len(words_of(text)) >= 20:
            fit.append(rows[-1])
    fit.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(fit[:25 * len(fit) // 100]):
        r[4] = i + 1
    return sorted(map(tuple, rows), key=repr)


def resampled(docs, targets):
    return sorted((tuple(r) for r in R.resample(docs, targets).collect()), key=repr)


def test_equals_plain_version(spark):
    docs, bench = table(spark, SMALL, "documents"), table(spark, SMALL, "benchmark")
    want = plain([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in bench.collect()])
    assert resampled(docs, bench) == want
    assert max(r[4] or 0 for r in want) > 10


def test_edge_rows(spark):
    rng = random.Random(2)
    some = ["".join(rng.choice("ab Cé,\t\n0１ß") for _ in range(200)) for _ in range(30)]
    docs = [(i, t) for i, t in enumerate(some)] + [(50, None), (51, ""), (52, "  ..."), (None, some[0]), (3, some[3]), (3, some[3])]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], SCHEMA + ", key string, n_words int")
    targets = [some[1], None, ""]
    bench = spark.createDataFrame([(t, 1) for t in targets], "text string, key int")
    assert resampled(df, bench) == plain(docs, targets)
    assert R.resample(df.limit(0), bench).count() == 0
    assert resampled(df, bench.limit(0)) == plain(docs, [])


@pytest.mark.parametrize("longest", [1, 2, 3, 4])
def test_blocks_do_not_change_features(longest, monkeypatch):
    rng = random.Random(longest)
    pattern = R.spans_pattern(longest)
    for block in (1, 5, 17, 1 << 20):
        monkeypatch.setattr(R, "BLOCK_BYTES", block)
        for _ in range(60):
            text = " ".join("".join(rng.choice("abé1") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(0, 12)))
            n, got = R.feature_buckets(R.collapse(text), longest, 10000, pattern)
            assert n == len(words_of(text)) and sorted(got.tolist()) == sorted(buckets_of(text, longest))


def test_collapse_keeps_words():
    assert R.collapse("The  QUICK-brown Éa 1_2 ①\n") == "the quick brown Éa 1 2 ①".encode()
    assert R.collapse(None) == R.collapse(" \x00~") == b""


def test_hot_equal_rows_are_spread(spark):
    """A third of all rows equal: positions are still whole and unique."""
    rows = spark.createDataFrame([(i, 5 if i % 3 == 0 else i) for i in range(900)], "key long, score long")
    from pyspark.sql import functions as F
    from motorlake.llm.common import saved
    got = R.with_positions(saved(rows, "hot"), [F.desc("score")]).collect()
    assert sorted(r.position for r in got) == list(range(900))
    by = sorted(got, key=lambda r: r.position)
    assert all(a.score >= b.score for a, b in zip(by, by[1:]))
    assert np.all(np.diff([r.position for r in by]) == 1)
