"""The pipeline: every stage against brute force on its own input, and the run as a whole."""

import os
import shutil

import corpus_pipeline
import pytest
from motorlake.llm.common import saved
from test_search_operators import brute_classes, brute_dedup, shingles
from test_token_operators import BYTES, crc, library_ids

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """sf0.001 with odd rows and extra columns added to its documents."""
    at = str(tmp_path_factory.mktemp("corpus"))
    shutil.copy(f"{SF}/benchmark.parquet", f"{at}/benchmark.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs.orderBy("doc_id").first()
    odd = [(10_000, None, "en", "x", 0), (10_001, "", "en", "x", 0), (10_002, "123 ... !", None, None, None), (10_003, first.text, "en", "x", 1),
           (10_004, first.text.replace(" ", "  ", 1).upper(), "en", "x", 1), (10_005, "word " * 3000, "en", None, 2)]
    extra = spark.createDataFrame(odd, docs.schema)
    docs.union(extra).selectExpr("*", "'e' AS lang_pred", "1 AS n_removed", "'l' AS length").write.parquet(f"{at}/documents.parquet")
    return at


@pytest.fixture(scope="module")
def stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(saved(stage(spark, out[-1], folder), "stage"))
    return out


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_stages_keep_the_columns(stages):
    for out in stages[1:-1]:
        assert out.columns == stages[0].columns
    assert len(corpus_pipeline.STAGES) == 5 and os.path.exists(corpus_pipeline.__file__)


def test_language_drops_texts_without_a_language(stages):
    lost = {i for i, _ in rows(stages[0])} - {i for i, _ in rows(stages[1])}
    assert lost == {10_000, 10_001, 10_002}


def test_lines(stages):
    want = brute_dedup(rows(stages[1]), 5, 10)
    expected = []
    for i, t in rows(stages[1]):
        own = [x for x in t.split("\n") if x.strip()]
        kept = [x for n, x in enumerate(own) if n not in want[i]]
        if kept:
            expected.append((i, t if len(kept) == len(own) else "\n".join(kept)))
    assert rows(stages[2]) == expected and len(expected) < len(rows(stages[1]))
    assert all(r.n_chars == len(r.text) for r in stages[2].collect() if r.doc_id < 10_000)


def test_near_duplicates(stages):
    want = {i for i, c in brute_classes(rows(stages[2])) if i == c}
    assert rows(stages[3]) == [(i, t) for i, t in rows(stages[2]) if i in want]


def test_benchmark(spark, stages):
    items = [shingles(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if len(r.text.split()) >= 5]
    want = [(i, t) for i, t in rows(stages[3]) if not any(len(q & shingles(t)) >= 0.8 * len(q) for q in items)]
    assert rows(stages[4]) == want and len(want) < len(rows(stages[3]))


def test_packing(spark, folder, stages):
    got = {}
    for r in sorted(stages[5].collect(), key=lambda r: (r.doc_id, r.piece)):
        got.setdefault(r.doc_id, []).append(r)
    for i, t in rows(stages[4]):
        ids = library_ids(BYTES, t) + [2]
        assert sum(r.length for r in got[i]) == len(ids) and all(r.ids_crc32 == crc(ids[r.start:r.start + r.length]) for r in got[i])
    assert len(got) == len(rows(stages[4]))
    again = corpus_pipeline.run(spark, folder)
    assert again.columns == stages[5].columns
    key = lambda df: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert key(again) == key(stages[5])


def test_empty_documents(spark, folder, tmp_path):
    shutil.copy(f"{SF}/benchmark.parquet", tmp_path / "benchmark.parquet")
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
