"""Nearest neighbours against brute force: recall, scores, ties, and rows that take no part."""

import numpy as np
import pytest

from conftest import SMALL
from motorlake.llm import projected_neighbours as P
from motorlake.llm.common import table

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, every, k):
    """query_id -> [(vec_id, score)] over distinct ids."""
    ids = [i for i, _ in rows]
    x = np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    out = {}
    for i, q in zip(ids, x):
        if i % every == 0:
            s = (x * q).sum(axis=1)
            out[i] = sorted(((-s[j], ids[j]) for j in range(len(ids)) if ids[j] != i))[:k]
    return {i: [(v, -s) for s, v in hits] for i, hits in out.items()}


def found(df, **options):
    out = {}
    for r in sorted(P.nearest(df, **options).collect(), key=lambda r: (r.query_id, r.rank)):
        hits = out.setdefault(r.query_id, [])
        hits.append((r.vec_id, r.score))
        assert r.rank == len(hits)
    return out


def recall(got, want):
    return np.mean([len({v for v, _ in got[q]} & {v for v, _ in hits}) / len(hits) for q, hits in want.items()])


def clustered(n, seed, d=24, centres=40):
    rng = np.random.RandomState(seed)
    x = rng.standard_normal((centres, d))[rng.randint(centres, size=n)] + 0.25 * rng.standard_normal((n, d))
    return [(i, x[i].astype(np.float32).tolist()) for i in range(n)]


def test_table_recall(spark):
    df = table(spark, SMALL, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got, want = found(df), brute(rows, 20, 20)
    assert got.keys() == want.keys() and recall(got, want) >= 0.9
    scores = {(q, v): s for q, hits in brute(rows, 20, len(rows)).items() for v, s in hits}
    for q, hits in got.items():
        assert len(hits) == 20 and hits == sorted(hits, key=lambda h: (-h[1], h[0]))
        for v, s in hits:
            assert s == pytest.approx(scores[q, v], abs=1e-12)


@pytest.mark.parametrize("norms", ["unit", "mixed"])
def test_many_shards(spark, monkeypatch, norms):
    """Cells, several shards a cell and several norm bands; most leaves stay closed on clustered vectors."""
    monkeypatch.setattr(P, "CELL_POINTS", 200)
    monkeypatch.setattr(P, "MOST_CELLS", 6)
    monkeypatch.setattr(P, "LEAF", 16)
    monkeypatch.setattr(P, "SAMPLE", 500)
    rng = np.random.RandomState(5)
    rows = [(i, (np.array(v) * (1 if norms == "unit" else 10.0 ** rng.randint(-2, 3))).astype(np.float32).tolist()) for i, v in clustered(3000, 1)]
    got, want = found(spark.createDataFrame(rows, SCHEMA).repartition(3), k=10), brute(rows, 20, 10)
    assert got.keys() == want.keys() and recall(got, want) >= 0.9
    assert all(len(h) == 10 for h in got.values())


def test_stops_before_all_leaves():
    rows = clustered(4000, 3)
    x = np.array([v for _, v in rows])
    projection = P.Projection(x.shape[1])
    x /= np.linalg.norm(x, axis=1)[:, None]
    bands = projection.bands(projection.norms(x))
    assert set(bands) == {0}
    shard = P.Shard(0, np.arange(len(x)), x, projection.points(x, bands))
    seen = []
    real = shard.vectors

    class Counted(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, slice):
                seen.append(at)
            return np.asarray(super().__getitem__(at))

    shard.vectors = real.view(Counted)
    q = x[:1]
    who, place = shard.search(projection, q, np.array([-np.inf]), 11, P.chi_square_quantile(0.95))
    assert len(who) == 11 and len(seen) < len(shard.starts) / 2


def test_hot_vector_and_ties(spark):
    """A third of all rows hold one vector: ties go to the smaller id, the own id is left out."""
    rows = clustered(300, 2)
    rows = [(i, rows[0][1] if i % 3 == 0 else v) for i, v in rows]
    got, want = found(spark.createDataFrame(rows, SCHEMA), k=5), brute(rows, 20, 5)
    for q in (0, 60, 120):
        assert [v for v, _ in got[q]] == [v for v, _ in want[q]]
    assert got.keys() == want.keys() and recall(got, want) >= 0.9


def test_rows_without_part(spark):
    good = [(i, [float(i + 1), 1.0]) for i in range(1, 30)]
    bad = [(40, None), (60, [0.0, 0.0]), (80, [float("nan"), 1.0]), (100, [float("inf"), 1.0]), (120, [1.0, None]), (None, [1.0, 2.0]),
           (140, []), (160, [1.0, 2.0, 3.0])]
    rows = good + bad + [good[5], (20, [0.5, 0.5])]
    df = spark.createDataFrame([(*r, 3, "x") for r in rows], SCHEMA + ", key int, cell string")
    least = [(i, v if i != 20 else [0.5, 0.5]) for i, v in good]
    got = found(df)
    assert got.keys() == {20} and [v for v, _ in got[20]] == [v for v, _ in brute(least, 20, 20)[20]]
    few = spark.createDataFrame(good[:3] + [(20, [1.0, 1.0])], SCHEMA)
    assert [v for v, _ in found(few)[20]] == [3, 2, 1]
    assert found(df.limit(0)) == {} and found(spark.createDataFrame([(20, [1.0, 2.0])], SCHEMA)) == {}


def test_chi_square():
    assert P.chi_square(P.chi_square_quantile(0.95, 8), 8) == pytest.approx(0.95)
    assert P.chi_square_quantile(0.95, 8) == pytest.approx(15.5073, abs=1e-3)
    assert P.chi_square_quantile(0.5, 2) == pytest.approx(2 * np.log(2))
